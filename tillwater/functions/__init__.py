"""Column expressions: hashing, dates, text, repair, JSON and region lookup."""
