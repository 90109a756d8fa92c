"""Land extract files as they arrive, each once per checkpoint.

The transformation is the batch one (``bronze_frame``); the file source and
its checkpoint remember which files were already landed, so a restart after
a failure neither skips nor repeats a file. ``available_now`` processes what
is there and stops, which suits a scheduled job; otherwise the query keeps
running and picks up new files on each trigger.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillroll.plans.bronze import DEFAULT_SCHEMAS, DatasetSpec, bronze_frame
from tillroll.schemas import DATE_PARTS
from tillroll.sources.extracts import DIALECT, apply_schema, text_schema


def ingest_stream(
    spark: SparkSession,
    spec: DatasetSpec,
    checkpoint_location: str,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Start a file-to-Parquet stream for one dataset folder.

    ``checkpoint_location`` belongs to the output and must be the same at every
    start. ``spec.input`` is a folder to watch; a file whose header differs from
    the declared columns fails the query. Columns are taken in file order and
    converted to the declared types as in the batch read; a value that does
    not fit becomes NULL.
    Without ``available_now`` the query runs on, checking every ``interval``.
    """
    schema = spec.schema or DEFAULT_SCHEMAS[spec.name]
    reader = (
        spark.readStream.option("header", True)
        .option("encoding", spec.encoding)
        .option("mode", "PERMISSIVE")
        .option("multiLine", spec.multi_line)
        .option("enforceSchema", False)
        .options(**DIALECT)
        .schema(text_schema(schema))
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = bronze_frame(apply_schema(reader.csv(spec.input), schema), spec.partitioned)
    if spec.partitioned:
        stream = stream.repartition(*DATE_PARTS)  # a day's rows of a batch go to one file, not to one a task
    writer = (
        stream.writeStream.format("parquet")
        .option("path", spec.output)
        .option("checkpointLocation", checkpoint_location)
        .outputMode("append")
    )
    if spec.partitioned:
        writer = writer.partitionBy(*DATE_PARTS)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
