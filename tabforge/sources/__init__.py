"""Reading and writing tables, results and fitted state."""
