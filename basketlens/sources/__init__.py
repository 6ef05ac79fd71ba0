"""Input schemas, fixture derivations from the driver tables, and file I/O."""
