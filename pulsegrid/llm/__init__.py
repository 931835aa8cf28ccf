"""Operators on text for language models: token ids, packing and truncation. Nothing else in the package imports this."""
