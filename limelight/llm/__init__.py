"""Operators that prepare training text: rules, filters, classifiers, deduplication, packing."""
