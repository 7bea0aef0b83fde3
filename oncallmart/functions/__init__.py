"""Column expressions: every rule is written once, as Column -> Column."""
