"""Operators for preparing training data: PII, toxicity, deduplication, licences, quality, mixing, tokens, scoring."""
