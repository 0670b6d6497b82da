"""Column expressions: cleaning rules, money and rounding, display text."""
