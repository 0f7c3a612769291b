"""Column expressions: text normalisation and scoring formulas."""
