"""Column expressions: hashes, arrays, images and losses."""
