"""Column expressions and the numeric bodies of the per-series fits."""
