"""Corpus preparation for language models: ten operators over `documents` and `pages`, and their queries."""
