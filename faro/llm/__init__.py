"""Operators of a training-data pipeline: near-duplicates, filters, decontamination, PII, packing.

Nothing else in the library imports this subpackage.
"""
