"""Training-data operators: dedup, quality, language models, mixing."""
