"""Column functions: vectors, rotations, strings and time."""
