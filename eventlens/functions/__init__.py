"""Column expressions: each takes and returns Columns, and runs inside the JVM."""
