"""Column expressions: text, JSON, hashes, vectors, advantages."""
