"""Column functions: no joins, no actions, no Python on the data path."""
