"""Column expressions (JVM-side, codegen-friendly); no Python per row."""
