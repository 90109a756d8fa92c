"""Operators for training-data pipelines: quality, decontamination, dedup, packing.

Each module holds one operator with its own general interface. ``queries``
derives the registered digests from them. Nothing outside this subpackage
imports it.
"""
