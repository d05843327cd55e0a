"""Column functions: text cleaning, labels, redaction, rewriting, scores and formats."""
