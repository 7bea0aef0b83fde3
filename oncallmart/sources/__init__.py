"""Reading tickets and writing tables."""
