"""Column expressions: conversions, codecs and geometry."""
