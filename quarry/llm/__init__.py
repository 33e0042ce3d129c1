"""Operators of a training-data pipeline: scans, near-duplicate search,
classification, decontamination, chat formatting, tokenising and sharding.

Nothing else in ``quarry`` imports this subpackage.
"""
