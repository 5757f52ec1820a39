"""Column-level helpers: everything here returns Spark ``Column`` objects."""
