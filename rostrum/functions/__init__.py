"""Column expressions and the numpy helpers used inside Arrow batches."""
