"""Column-level scalar functions (JVM-side expressions, no Python UDFs)."""
