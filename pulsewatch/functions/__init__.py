"""Column expressions; everything here runs inside the JVM unless stated."""
