"""Column expressions; all run inside the JVM and work on tables and streams."""
