"""Column to Column helpers, all evaluated inside the JVM."""
