"""Column functions: each takes columns and returns a column, all evaluated in the JVM."""
