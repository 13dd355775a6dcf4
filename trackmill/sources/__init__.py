"""Reading landed documents and writing tables."""
