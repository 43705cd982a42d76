"""Column expressions and window helpers; all of them stay inside generated JVM code."""
