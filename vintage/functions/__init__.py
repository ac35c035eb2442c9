"""Column expressions and helpers for ordering rows at scale."""
