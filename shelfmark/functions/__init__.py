"""Column functions: no Python runs per row in any of them."""
