"""Column expressions: HTML text, URLs, stemming, varint sizes."""
