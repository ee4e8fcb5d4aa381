"""Operators for preparing training data: near-duplicates, tokenising, language,
licences, quality, line spread, toxicity and source mixing."""
