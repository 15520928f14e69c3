"""Column-expression builders. All return JVM-side ``Column`` expressions (no UDFs)."""
