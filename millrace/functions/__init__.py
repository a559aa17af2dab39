"""Column and row level functions."""
