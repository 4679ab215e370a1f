"""Column-level helpers: text cleaning, hash sampling, sparse vectors."""
