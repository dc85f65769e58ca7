"""Reading and writing: parquet tables, text files, JSON, catalogues."""
