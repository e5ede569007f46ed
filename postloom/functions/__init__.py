"""Column -> Column functions. All of them stay in the JVM."""
