"""DataFrame-in, DataFrame-out operators over the canonical series."""
