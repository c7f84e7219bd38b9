"""Column expressions (JVM built-ins only): parsing, keys, flags, labels, order keys."""
