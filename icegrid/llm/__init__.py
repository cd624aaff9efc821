"""Operators for training corpora: dedup, decontamination, filters, sharding and tokens.

Nothing else in the library imports this package; it borrows general helpers from it.
"""
