"""Column expressions: text cleaning, sentiment labels, rounded ratios."""
