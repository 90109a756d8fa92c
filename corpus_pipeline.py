"""Corpus pipeline: from raw documents to packed training sequences.

Quality rules, near-dedup, substring dedup, decontamination and packing, each
over everything the stage before it kept. Every stage's result is written as
Parquet to the shared scratch folder and read again, so a lost executor costs
the current stage's tasks at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import decontam, near_dedup, packing, phrase_dedup, quality_rules, queries
from tillroll.session import delete_path, scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.drop_near_duplicates(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that recur; those left without words go.
    Documents that lose nothing keep their text as it is."""
    spec = phrase_dedup.spec_for(keep_layout=True)
    # The other columns travel in a struct, so none can clash with a result's name.
    others = F.struct(*[F.col(c) for c in docs.columns if c != "text"])
    cut = phrase_dedup.remove_repeated_passages(docs.select(others.alias("_row"), "text"), spec=spec)
    text = F.col("kept").cast("string")
    values = {"text": text, "n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)}
    kept = cut.filter("n_removed = 0 OR n_removed < n_symbols")
    return kept.select([values.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns])


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    return decontam.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in training sequences, with their ids."""
    return packing.pack_documents(docs, queries.tokenizer_path(packing.TOKENIZER_FILE)).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("decontamination", benchmark_leaks),
    ("packing", pack),
]

# Token packing has no SQL form; a brute-force version checks run() in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. A stage's copy is deleted when the next
    stage has been written; the last one is read by the result."""
    docs, written = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        result = stage(spark, docs, sf_dir)
        result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
        if written:
            delete_path(spark, written)
        written = path
    return STAGES[-1][1](spark, docs, sf_dir)
