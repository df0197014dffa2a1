"""Column expressions shared by the marts (all JVM-side built-ins)."""
