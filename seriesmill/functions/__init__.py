"""Column-level functions and exact distributed order statistics."""
