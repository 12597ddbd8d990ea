"""Column-expression builders (all JVM-side, whole-stage-codegen friendly)."""
