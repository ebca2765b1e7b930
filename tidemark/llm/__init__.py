"""Training-data operators: extraction, deduplication, encoding, filtering, mixing and search over text and vectors."""
