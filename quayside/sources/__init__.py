"""Reading from and writing to tables, folders and databases."""
