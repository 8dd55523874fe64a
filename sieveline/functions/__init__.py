"""Column expressions: text, vectors, bits, quantiles, geometry and rates."""
