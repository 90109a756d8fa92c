"""Ingest by manifest: each run lands only files that it has not landed yet.

``data/batch=N`` holds the rows a run landed, with the file they came from;
``files/batch=N`` lists that run's files (path, size, time of change) and makes
the rows count. It is written last: a run that stops before leaves rows that
readers ignore, and the next run writes the same batch again. Repeating a run
lands nothing. A file that changed in place is landed anew, and its earlier
rows no longer count.

The input folder is listed by Spark's file source, whose file index also lists
large trees with tasks; file contents are not read for it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.plans.bronze import DEFAULT_SCHEMAS, DatasetSpec, bronze_frame
from tillroll.session import path_exists
from tillroll.sources.extracts import read_csv

FILES = T.StructType(
    [
        T.StructField("file", T.StringType()),  # as rows name it (special characters encoded)
        T.StructField("path", T.StringType()),  # as a reader takes it
        T.StructField("bytes", T.LongType()),
        T.StructField("modified", T.TimestampType()),
    ]
)
FILE_COLUMN = "source_file"


def list_files(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """``file``, ``path``, ``bytes`` and ``modified`` of all files under a folder."""
    if not path_exists(spark, folder):
        return spark.createDataFrame([], FILES)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    return found.select(
        F.col("_metadata.file_path").alias("file"),
        "path",
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified"),
    )


@dataclass(frozen=True)
class LandedFiles:
    spark: SparkSession
    path: str
    spec: DatasetSpec

    def _schema(self) -> T.StructType:
        return self.spec.schema or DEFAULT_SCHEMAS[self.spec.name]

    def _stored(self, part: str, schema: T.StructType) -> DataFrame:
        where, typed = f"{self.path}/{part}", T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
        if not path_exists(self.spark, where):
            return self.spark.createDataFrame([], typed)
        return self.spark.read.schema(typed).parquet(where)

    def files(self) -> DataFrame:
        """All files landed so far, with the batch each version came in."""
        return self._stored("files", FILES)

    def new_files(self) -> DataFrame:
        """Files in the input folder that are not landed in their present version."""
        return list_files(self.spark, self.spec.input).join(self.files(), [f.name for f in FILES.fields], "left_anti")

    def run(self) -> int:
        """Land what is new; returns the number of files. Their paths pass
        through the driver, as any file read's paths do."""
        new = [tuple(r) for r in self.new_files().collect()]
        if not new:
            return 0
        batch = (self.files().agg(F.max("batch")).first()[0] or 0) + 1
        spec = self.spec
        rows = read_csv(self.spark, [f[1] for f in new], schema=self._schema(), encoding=spec.encoding, multi_line=spec.multi_line)
        rows = bronze_frame(rows, spec.partitioned).withColumn(FILE_COLUMN, F.col("_metadata.file_path"))
        rows.write.mode("overwrite").parquet(f"{self.path}/data/batch={batch}")
        listed = self.spark.createDataFrame(new, FILES).coalesce(1)
        listed.write.mode("overwrite").parquet(f"{self.path}/files/batch={batch}")
        return len(new)

    def rows(self) -> DataFrame:
        """The rows that count: of every landed file its latest version."""
        schema = bronze_frame(self.spark.createDataFrame([], self._schema()), self.spec.partitioned).schema
        stored = self._stored("data", T.StructType([*schema.fields, T.StructField(FILE_COLUMN, T.StringType())]))
        files = self.files()
        listed = files.select("batch").distinct()
        latest = files.groupBy("file").agg(F.max("batch").alias("latest"))
        # Usually empty: adaptive execution then drops the join.
        replaced = files.join(latest, "file").filter("batch < latest").select(F.col("file").alias(FILE_COLUMN), "batch").distinct()
        return stored.join(listed, "batch", "left_semi").join(replaced, [FILE_COLUMN, "batch"], "left_anti").drop("batch")
