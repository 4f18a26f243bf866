"""Column functions: calendar arithmetic and message classification."""
