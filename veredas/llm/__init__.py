"""Operators for preparing training data: linking, surviving records, matching, packing, mixing, levels."""
