"""Column-level functions: everything here returns Spark Column expressions."""
