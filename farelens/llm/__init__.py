"""Training-data operators: dedup, language, quality, URL, mixing and tokenizer
steps for corpora. Nothing else in the library imports this subpackage."""
