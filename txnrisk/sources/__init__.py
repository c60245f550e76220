"""Reading and writing: files, tables, models."""
