"""Reading and writing the bronze, silver and gold tables."""
