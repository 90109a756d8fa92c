"""Compaction of date folders: many small files become few of a target size.

Files are packed folder by folder: a file that has the target size stays in a
bin of its own, smaller ones fill bins in order of size up to the target.
Folders that would not get fewer files are left alone. All others are rewritten
in one job to a staging folder beside the table, a task a bin, and then
swapped in folder by folder: the old folder is renamed aside, the new one
renamed into its place, the old one deleted. Only names change hands on the
driver; rows do not.

A job that stops before the swap has changed nothing. One that stops within a
folder's swap leaves the old folder aside, and ``recover`` (or the next
compaction) brings it back or deletes it. Writers must not add to the folders
while they are compacted.
"""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.plans.manifest import list_files
from tillroll.schemas import DATE_PARTS
from tillroll.session import delete_path, run_actions

TARGET_BYTES = 256 << 20
_ASIDE = ".old-"


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """``folder``, ``file`` and ``bytes`` of a table's Parquet files."""
    files = list_files(spark, path, "*.parquet").filter(~F.contains("path", F.lit(f"/{_ASIDE}")))
    return files.select(F.regexp_replace("path", "/[^/]+$", "").alias("folder"), "file", "bytes")


def packed_files(files: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Every file of the folders worth rewriting with its ``bin``."""
    big = F.col("bytes") >= target_bytes
    by_folder = Window.partitionBy("folder")
    before = by_folder.orderBy("bytes", "file").rowsBetween(Window.unboundedPreceding, -1)
    small_bytes = F.coalesce(F.sum(F.when(~big, F.col("bytes"))).over(before), F.lit(0))
    bins = F.when(big, F.concat(F.lit("big "), "file")).otherwise(F.floor(small_bytes / F.lit(target_bytes)).cast("string"))
    packed = files.withColumn("bin", bins)
    counted = packed.withColumn("_files", F.count(F.lit(1)).over(by_folder)).withColumn(
        "_bins", F.size(F.collect_set("bin").over(by_folder))
    )
    return counted.filter("_bins < _files").drop("_files", "_bins")


class _Files:
    """Renames through Hadoop's file system."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def qualified(self, path: str) -> str:
        """The path as listings name it."""
        return self._fs.makeQualified(self._path(path)).toString()

    def folders(self, folder: str) -> list[str]:
        return [s.getPath().toString() for s in self._fs.listStatus(self._path(folder)) if s.isDirectory()]

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def move(self, source: str, target: str) -> None:
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"could not rename {source} to {target}")

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


def _beside(folder: str, prefix: str) -> str:
    parent, name = folder.rsplit("/", 1)
    return f"{parent}/{prefix}{name}"  # a leading dot: readers skip it


def swap(files: _Files, folder: str, fresh: str) -> None:
    """Put ``fresh`` in the place of ``folder``."""
    aside = _beside(folder, _ASIDE)
    files.move(folder, aside)
    files.move(fresh, folder)
    files.delete(aside)


def recover(spark: SparkSession, path: str, depth: int = len(DATE_PARTS)) -> int:
    """Finish or undo swaps that were stopped; returns how many there were."""
    files, level, found = _Files(spark, path), [path], 0
    for _ in range(depth):
        inner = []
        for folder in level:
            for child in files.folders(folder):
                name = child.rsplit("/", 1)[1]
                if name.startswith(_ASIDE):
                    place = f"{folder}/{name.removeprefix(_ASIDE)}"
                    if files.exists(place):
                        files.delete(child)  # the new folder was already in place
                    else:
                        files.move(child, place)
                    found += 1
                else:
                    inner.append(child)
        level = inner
    return found


def compact(
    spark: SparkSession, path: str, partition_by: Sequence[str] = DATE_PARTS, target_bytes: int = TARGET_BYTES, max_parallel: int = 8
) -> dict[str, int]:
    """Compact a partitioned Parquet table in place; returns the number of
    folders rewritten and of their files before and after."""
    files = _Files(spark, path)
    path = files.qualified(path.rstrip("/"))
    recover(spark, path, len(partition_by))
    # The bins are read twice and must not change in between.
    staging = f"{path.rsplit('/', 1)[0]}/.compact-{uuid.uuid4().hex}"
    packed_files(data_files(spark, path), target_bytes).write.parquet(f"{staging}/plan")
    plan = spark.read.schema("folder string, file string, bytes bigint, bin string").parquet(f"{staging}/plan")
    before = plan.count()
    if not before:
        delete_path(spark, staging)
        return {"folders": 0, "files_before": 0, "files_after": 0}
    numbered = plan.withColumn("_bin", F.xxhash64("bin")).select(F.col("file").alias("_file"), "_bin")
    folders = [r[0] for r in plan.select("folder").distinct().collect()]  # names of folders
    schema = spark.read.parquet(path).schema
    rows = spark.read.schema(schema).option("basePath", path).parquet(*folders).withColumn("_file", F.col("_metadata.file_path"))
    # A bin has one target size of rows at most (or one big file), so a task
    # that writes a bin is bounded; a day of many bins is spread over tasks.
    rows.join(numbered, "_file").repartition(*partition_by, "_bin").drop("_file", "_bin").write.partitionBy(*partition_by).parquet(
        f"{staging}/data"
    )

    def replace(folder: str) -> None:
        swap(files, folder, f"{staging}/data/{folder.removeprefix(f'{path}/')}")

    after = data_files(spark, f"{staging}/data").count()
    run_actions([lambda f=f: replace(f) for f in folders], max_parallel)
    delete_path(spark, staging)
    return {"folders": len(folders), "files_before": before, "files_after": after}
