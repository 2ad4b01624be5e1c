"""Column expressions: cleaning, exact decimals, calendar parts, change hashes."""
