"""Incremental ingest with Structured Streaming.

The source flow is batch only. The one place where arriving data matters is
the bronze ingest: new extract files are landed the same way as in batch
(see ``tillroll.streaming.ingest``), with a checkpoint recording which files
were already taken.
"""
