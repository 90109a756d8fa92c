"""CSV reads that keep what does not fit.

A permissive read turns a record with too few or too many fields, or a value
that is not of its type, into NULLs, and the text is gone. Here such records
come back beside the good ones, with their text and the reason, so that they
can be stored, counted and repaired.

Reasons: ``fields`` (the record does not have the header's number of fields,
or a quote is never closed) or ``type:<column>`` (the first column whose text
is not of the declared type). An empty value is missing, not broken.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.text import clean_header
from tillroll.sources.extracts import DIALECT, text_schema, typed_column

RECORD = "_record"


@dataclass(frozen=True)
class CheckedRead:
    """``good`` has the declared columns; ``broken`` ``record``, ``reason`` and
    ``file``. Both are filters over one lazy scan."""

    good: DataFrame
    broken: DataFrame


def read_csv_checked(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    encoding: str = "UTF-8",
    multi_line: bool = True,
) -> CheckedRead:
    """Header CSV with a declared schema, split into good and broken records.

    Columns are matched by their normalised header names; all files must have
    the first file's header. The broken side's ``record`` is the text as it
    stands in the file for a wrong number of fields, and the fields written as
    CSV again for a value of the wrong type.
    """
    reader = spark.read.option("header", True).option("encoding", encoding).option("multiLine", multi_line).options(**DIALECT)
    names = reader.csv(paths).columns
    text = text_schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
    raw = (
        reader.option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", RECORD)
        .option("columnPruning", False)  # a pruned read does not count the fields
        .schema(T.StructType([*text.fields, T.StructField(RECORD, T.StringType())]))
        .csv(paths)
    )
    plain = [clean_header(n) for n in names]
    missing = [f.name for f in schema.fields if f.name not in plain]
    if missing:
        raise ValueError(f"CSV header lacks columns {missing}; found {plain}")
    rows = raw.select(
        *[F.col(f"`{n}`").alias(c) for n, c in zip(names, plain)], RECORD, F.col("_metadata.file_path").alias("_file")
    )
    reason = F.when(F.col(RECORD).isNotNull(), F.lit("fields"))
    for field in schema.fields:
        if not isinstance(field.dataType, T.StringType):
            wrong = (F.coalesce(F.trim(field.name), F.lit("")) != "") & typed_column(field.name, field.dataType).isNull()
            reason = reason.when(wrong, F.lit(f"type:{field.name}"))
    judged = rows.withColumn("_reason", reason)
    good = judged.filter(F.col("_reason").isNull()).select(
        [typed_column(f.name, f.dataType).alias(f.name) for f in schema.fields]
    )
    again = F.to_csv(F.struct(*plain), {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    broken = judged.filter(F.col("_reason").isNotNull()).select(
        F.coalesce(F.col(RECORD), again).alias("record"), F.col("_reason").alias("reason"), F.col("_file").alias("file")
    )
    return CheckedRead(good, broken)
