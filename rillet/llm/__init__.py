"""Operators for large training-data pipelines: language id, personal data, BPE,
packing, deduplication, exact search and toxicity. Nothing else in the library
imports this subpackage."""
