"""Operators for preparing training text: tokens, filters, duplicates, personal data, pages, archives and language models."""
