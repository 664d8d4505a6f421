"""Data tests. Each returns its failing rows as a DataFrame; empty means passed."""
