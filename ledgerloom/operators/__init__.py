"""Relational operators: de-duplication, Silver curation, ranking, Gold marts,
quality profiles and behavioural signals."""
