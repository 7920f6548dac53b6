"""Column functions: no shuffles, no Python in the data path."""
