"""Operators for preparing training data: near duplicates, search, filters,
extraction, language models, mixing and tokenisation."""
