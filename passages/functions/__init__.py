"""Column expressions that Catalyst plans without leaving the JVM."""
