"""Column expressions. All are built-in JVM expressions, so they stay inside whole-stage codegen."""
