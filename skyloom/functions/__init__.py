"""Column expressions: Column in, Column out, nothing leaves the JVM."""
