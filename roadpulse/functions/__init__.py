"""Column expressions. All of them are built-in functions, so they stay in the JVM."""
