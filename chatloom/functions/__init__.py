"""Column functions. Each takes columns and returns a column; none leaves the JVM unless it says so."""
