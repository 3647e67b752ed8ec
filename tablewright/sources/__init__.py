"""Reading and writing typed tables."""
