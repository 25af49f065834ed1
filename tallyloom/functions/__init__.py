"""Column expressions: money, text keys, hashed draws."""
