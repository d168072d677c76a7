"""Column-expression helpers.  All JVM-side built-ins; no Python UDFs."""
