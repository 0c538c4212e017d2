"""Column expressions. No function here triggers a job or leaves the JVM."""
