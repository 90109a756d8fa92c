"""Session helpers.

``local_session`` is for tests and the benchmark only; library functions take
the caller's session (or just DataFrames) and never create one.

``scratch_dir`` resolves the shared folder used to cut lineage. On a cluster it
is whatever ``spark.checkpoint.dir`` names, and it is an error if that is
unset; a private temporary folder is used only with a local master (tests).
"""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor
from typing import Callable, Sequence, TypeVar

from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

# Settings the library is written for: adaptive execution re-plans joins from
# runtime sizes, splits skewed join partitions and coalesces small shuffles.
# Broadcast joins are chosen only from measured sizes: the static estimate
# (from compressed file sizes) can understate a side's size in memory.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(
    cpus: int | str = "*",
    shuffle_partitions: int = 8,
    app_name: str = "tillroll",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on)."""
    warehouse = tempfile.mkdtemp(prefix="tillroll-wh-")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", warehouse)
        .config("spark.sql.catalogImplementation", "in-memory")
    )
    for key, value in {**SCALE_CONF, **(extra_conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session, set to a temp dir if unset.

    ``spark.checkpoint.dir`` is a core setting that cannot be changed on a
    running session, so the fallback goes through the SparkContext.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tillroll-ckpt-"))
        path = spark.sparkContext.getCheckpointDir()
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared scratch folder."""
    return f"{scratch_dir(spark)}/tillroll/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared scratch folder and read it back.

    This cuts the lineage: later jobs restart from durable files rather than
    recomputing joins, and a lost executor costs only the tasks of the current
    stage. Parquet keeps the frame columnar so each reader prunes columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a job's own scratch through Hadoop's file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def run_actions(actions: Sequence[Callable[[], T]], max_parallel: int = 4) -> list[T]:
    """Run independent Spark actions (writes) as concurrent jobs.

    Each action is submitted from its own driver thread, so a small dataset's
    job uses the slots a large job leaves idle instead of waiting for it. With
    the default FIFO scheduler the first job keeps priority. Results come back
    in input order; the first failure is raised.
    """
    if max_parallel <= 1 or len(actions) <= 1:
        return [action() for action in actions]
    with ThreadPoolExecutor(max_workers=min(max_parallel, len(actions))) as pool:
        futures = [pool.submit(action) for action in actions]
        return [f.result() for f in futures]
