"""Reading stored tables, seeds and yearly survey tables; writing results."""
