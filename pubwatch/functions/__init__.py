"""Column functions: per-row work, all inside the JVM."""
