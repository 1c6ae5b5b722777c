"""Column-level functions (JVM-side expressions) and small per-value helpers."""
