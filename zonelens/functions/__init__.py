"""Column-expression builders (all JVM-side, inside whole-stage code generation)."""
