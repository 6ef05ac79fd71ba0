"""Configuration presets, the full pipeline and the registered query catalog."""
