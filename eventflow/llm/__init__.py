"""Training-data pipeline operators: dedup, scoring, search, tokenisation."""
