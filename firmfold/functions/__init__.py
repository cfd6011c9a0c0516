"""Column expressions: pure Column -> Column, evaluated in the JVM."""
