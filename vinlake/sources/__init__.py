"""Reading raw data, landing it, and writing tables."""
