"""Reading input tables, writing results."""
