"""Input tables: their schemas, text cleanup and readers."""
