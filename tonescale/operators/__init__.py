"""DataFrame transforms: dedup, cleaning, vocabulary, scoring, evaluation."""
