"""Reading configured sources and stored tables."""
