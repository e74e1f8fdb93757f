"""Column functions: sequences, codes, distances."""
