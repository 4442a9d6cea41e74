"""Column functions: grid cells, geometry, labels and text."""
