"""Split job: flat yearly extracts -> the three CSV datasets the ingest reads.

The extracts are parsed once: the flat rows are staged as Parquet in the
shared scratch folder, and the three datasets are column-pruned reads of
that copy, written as concurrent jobs. Without the staging step each
dataset would parse the (row-oriented) CSV text again. The copy is deleted
when the job ends.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import SparkSession

from tillroll.schemas import FLAT_EXTRACT
from tillroll.session import delete_path, run_actions, scratch_path
from tillroll.sources.extracts import concat_extracts, read_latin1_csv, split_extracts
from tillroll.sources.sinks import write_csv


def split_job(
    spark: SparkSession, extract_paths: Sequence[str], output_dir: str, max_parallel: int = 3, multi_line: bool = True
) -> dict[str, str]:
    """Write ``products.csv``, ``orders.csv`` and ``orders_line.csv`` folders
    under ``output_dir``; returns their locations by dataset name. Turn
    ``multi_line`` off for extracts without line breaks inside quoted text:
    each file is then split over tasks."""
    flat = concat_extracts(*[read_latin1_csv(spark, p, schema=FLAT_EXTRACT, multi_line=multi_line) for p in extract_paths])
    staging = scratch_path(spark, "flat-extracts")
    flat.write.parquet(staging)
    staged = spark.read.schema(flat.schema).parquet(staging)
    out = {name: f"{output_dir.rstrip('/')}/{name}.csv" for name in ("products", "orders", "orders_line")}
    parts = split_extracts(staged)
    try:
        run_actions([lambda n=n: write_csv(parts[n], out[n]) for n in out], max_parallel)
    finally:
        delete_path(spark, staging)
    return out
