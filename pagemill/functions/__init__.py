"""Column functions; everything here stays inside one row."""
