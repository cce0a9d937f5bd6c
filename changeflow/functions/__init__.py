"""Column expressions: content-derived keys, time and text helpers."""
