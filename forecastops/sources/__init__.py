"""Reading tables and writing to landing datasets."""
