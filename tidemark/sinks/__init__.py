"""Writers for files, documents, keyed tables and databases."""
