"""Column functions: hygiene of raw text, documents, names, labels."""
