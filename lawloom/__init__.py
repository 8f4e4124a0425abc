"""Spark jobs for versioned legislative documents: read, decode, join, chunk, embed, search."""
