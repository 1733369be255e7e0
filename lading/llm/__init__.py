"""Operators for preparing training data: near duplicates, packing, mixing, extraction, masking."""
