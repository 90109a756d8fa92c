"""Bronze: land the extract files as Parquet.

Each dataset is described by a ``DatasetSpec``; every dataset is one Spark
read-transform-write job, and the (few) jobs are submitted concurrently.
Orders get ``year``/``month``/``day`` from their date text and are written
into ``year=/month=/day=`` folders; a date that does not parse gives NULL
parts and lands in the default partition, to be quarantined downstream.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tillroll.functions.dates import date_parts
from tillroll.schemas import DATE_PARTS, LINES_RAW, ORDERS_RAW, PRODUCTS_RAW
from tillroll.session import run_actions
from tillroll.sources.extracts import read_csv
from tillroll.sources.sinks import write_parquet


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    input: str | tuple[str, ...]
    output: str
    partitioned: bool = False
    schema: T.StructType | None = None
    encoding: str = "UTF-8"
    # Line breaks inside quoted text; each file is then read by one task.
    multi_line: bool = True
    # Round-robin output file count for an unpartitioned dataset. None writes
    # each input split as it is read (no shuffle; file sizes follow the input
    # splits), which is what scales; the original flow used a fixed 8.
    num_partitions: int | None = None
    # For the date-partitioned dataset: replace only the days present in the
    # input (re-landing some days keeps all others).
    replace_partitions_only: bool = False


DEFAULT_SCHEMAS = {"products": PRODUCTS_RAW, "orders": ORDERS_RAW, "orders_line": LINES_RAW}


# The dataset names of the ingest (``orders_line`` and so on).
def standard_specs(input_dir: str, output_dir: str, multi_line: bool = True) -> list[DatasetSpec]:
    """The three datasets under one input folder and one output root.

    The lines have no free text, so their files are always split over tasks;
    ``multi_line`` says whether orders and products may have line breaks inside
    quoted text.
    """
    i, o = input_dir.rstrip("/"), output_dir.rstrip("/")
    return [
        DatasetSpec("orders_line", f"{i}/orders_line.csv", f"{o}/orders_line", schema=LINES_RAW, multi_line=False),
        DatasetSpec("orders", f"{i}/orders.csv", f"{o}/orders_partitioned", partitioned=True, schema=ORDERS_RAW, multi_line=multi_line),
        DatasetSpec("products", f"{i}/products.csv", f"{o}/products_partitioned", schema=PRODUCTS_RAW, multi_line=multi_line),
    ]


def bronze_frame(df: DataFrame, partitioned: bool) -> DataFrame:
    """The frame as landed: date parts added for the date-partitioned dataset."""
    return date_parts(df) if partitioned else df


def ingest_dataset(spark: SparkSession, spec: DatasetSpec, infer: bool = False) -> str:
    paths = list(spec.input) if isinstance(spec.input, tuple) else spec.input
    schema = None if infer else (spec.schema or DEFAULT_SCHEMAS.get(spec.name))
    df = read_csv(spark, paths, schema=schema, infer=infer, encoding=spec.encoding, multi_line=spec.multi_line)
    out = bronze_frame(df, spec.partitioned)
    if spec.partitioned:
        write_parquet(out, spec.output, partition_by=DATE_PARTS, replace_partitions_only=spec.replace_partitions_only)
    else:
        write_parquet(out, spec.output, num_partitions=spec.num_partitions)
    return spec.output


def ingest(
    spark: SparkSession, specs: Sequence[DatasetSpec], infer: bool = False, max_parallel: int = 3
) -> list[str]:
    """Land every dataset (as concurrent jobs); returns the output locations
    in spec order."""
    return run_actions([lambda s=spec: ingest_dataset(spark, s, infer=infer) for spec in specs], max_parallel)
