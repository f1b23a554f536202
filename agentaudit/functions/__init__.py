"""Column expressions: personal-data patterns, JSON reach-ins, text helpers."""
