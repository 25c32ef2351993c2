"""Column expressions: nothing here triggers work, everything stays in the JVM."""
