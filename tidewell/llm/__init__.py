"""Training-data operators: tokens, languages, duplicates, quality, language models and packing."""
