"""Column expressions: everything here is a Column in, a Column out, evaluated in the JVM."""
