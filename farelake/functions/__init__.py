"""Column functions: no shuffles, all JVM side."""
