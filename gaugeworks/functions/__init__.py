"""Column expressions.  All of them are built-ins and stay in the JVM."""
