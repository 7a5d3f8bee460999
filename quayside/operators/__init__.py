"""The public operators, one module per kind of warehouse work."""
