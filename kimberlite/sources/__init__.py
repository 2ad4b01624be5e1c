"""Reading raw files, reading and writing lake tables, staging intermediate tables."""
