"""Broken CSV records, ingest by manifest, clustered tables and compaction."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tests.oracle_check import compare_frame, duckdb_connection
from tillroll.plans import bronze, compact, manifest
from tillroll.schemas import DATE_PARTS, LINES_RAW, PRODUCTS_RAW
from tillroll.session import scratch_path
from tillroll.sources import clustered
from tillroll.sources.broken import read_csv_checked
from tillroll.sources.sinks import write_parquet


@pytest.mark.parametrize("multi_line", [False, True])
def test_broken_records_keep_their_text(spark, tmp_path, multi_line):
    path = tmp_path / "lines.csv"
    path.write_text('﻿InvoiceNo,StockCode,Quantity\n1,a,2\n2,b\n3,c,4,5\n4,"d, e",x\n5,,\n6,f,7.0\n7,g, \n8,"h ""q""",9\n', encoding="utf-8")
    read = read_csv_checked(spark, str(path), LINES_RAW, multi_line=multi_line)
    assert sorted(tuple(r) for r in read.good.collect()) == [
        ("1", "a", 2), ("5", None, None), ("6", "f", 7), ("7", "g", None), ("8", 'h "q"', 9)
    ]
    broken = {(r.record, r.reason) for r in read.broken.collect()}
    assert broken == {("2,b", "fields"), ("3,c,4,5", "fields"), ('4,"d, e",x', "type:Quantity")}
    assert read.broken.count() == 3 and read.good.count() == 5  # whatever columns are asked for
    assert all(r.file.endswith("lines.csv") for r in read.broken.collect())


def test_broken_records_of_several_types_and_missing_columns(spark, tmp_path):
    path = tmp_path / "products.csv"
    path.write_text("StockCode,Description,UnitPrice\na,one,1.5\nb,two,free\n", encoding="utf-8")
    read = read_csv_checked(spark, str(path), PRODUCTS_RAW)
    assert read.good.count() == 1 and [tuple(r)[:2] for r in read.broken.collect()] == [("b,two,free", "type:UnitPrice")]
    with pytest.raises(ValueError, match="lacks"):
        read_csv_checked(spark, str(path), LINES_RAW)


def _put(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as out:
        out.write("InvoiceNo,StockCode,Quantity\n" + "".join(f"{a},{b},{c}\n" for a, b, c in rows))


def test_each_file_is_landed_once(spark, tmp_path):
    inbox = str(tmp_path / "in box")
    landed = manifest.LandedFiles(spark, str(tmp_path / "landed"), bronze.DatasetSpec("orders_line", inbox, "", multi_line=False))
    assert landed.run() == 0 and landed.rows().count() == 0
    _put(inbox, "a.csv", [(1, "a", 1), (1, "a", 1)])
    _put(f"{inbox}/more", "b.csv", [(2, "b", 2)])
    assert landed.run() == 2
    assert landed.run() == 0
    _put(inbox, "c.csv", [(3, "c", 3)])
    _put(inbox, "empty.csv", [])
    assert landed.run() == 2
    assert sorted(map(tuple, landed.rows().drop(manifest.FILE_COLUMN).collect())) == [("1", "a", 1), ("1", "a", 1), ("2", "b", 2), ("3", "c", 3)]
    _put(inbox, "a.csv", [(1, "a", 100), (4, "d", 4)])  # changed in place
    assert landed.run() == 1 and landed.run() == 0
    assert sorted(map(tuple, landed.rows().drop(manifest.FILE_COLUMN).collect())) == [("1", "a", 100), ("2", "b", 2), ("3", "c", 3), ("4", "d", 4)]
    assert landed.files().count() == 5


def test_a_stopped_run_leaves_no_rows(spark, tmp_path):
    inbox = str(tmp_path / "inbox")
    landed = manifest.LandedFiles(spark, str(tmp_path / "landed"), bronze.DatasetSpec("orders_line", inbox, "", multi_line=False))
    _put(inbox, "a.csv", [(1, "a", 1)])
    rows = spark.createDataFrame([("9", "z", 9, "lost")], "InvoiceNo string, StockCode string, Quantity int, source_file string")
    rows.write.parquet(f"{landed.path}/data/batch=1")
    assert landed.rows().count() == 0
    assert landed.run() == 1
    assert [r.InvoiceNo for r in landed.rows().collect()] == ["1"]


def test_point_reads_open_few_files(spark):
    rng = random.Random(1)
    rows = [(None if i % 97 == 0 else str(rng.randrange(10_000, 99_999)), str(rng.randrange(1_000, 9_999)), i) for i in range(40_000)]
    df = spark.createDataFrame(rows, "InvoiceNo string, StockCode string, Quantity int")
    path = scratch_path(spark, "clustered")
    clustered.write_clustered(df, path, ("InvoiceNo", "StockCode"), files=64)
    total = spark.read.parquet(path).select(F.col("_metadata.file_path")).distinct().count()
    assert spark.read.parquet(path).count() == 40_000 and total >= 60
    shares = {"InvoiceNo": [], "StockCode": []}
    for _, (invoice, code, _) in zip(range(40), rng.sample(rows, 40)):
        for c, v in (("InvoiceNo", invoice), ("StockCode", code)):
            shares[c].append(len(clustered.files_with(spark, path, **{c: v})) / total)
    for c in shares:
        assert sum(shares[c]) / len(shares[c]) < 0.4, shares
    _, code, _ = rows[5]
    want = sorted(r for r in rows if r[1] == code)
    assert sorted(map(tuple, clustered.read_where(spark, path, StockCode=code).collect())) == want
    assert clustered.read_where(spark, path, InvoiceNo=None).count() == sum(r[0] is None for r in rows)
    assert clustered.read_where(spark, path, StockCode="none").collect() == []


def test_hot_code_is_spread_over_files(spark):
    df = spark.range(6000).select(F.col("id").cast("string").alias("InvoiceNo"), F.when(F.col("id") % 3 == 0, "85123A").otherwise(F.col("id").cast("string")).alias("StockCode"))
    path = scratch_path(spark, "clustered")
    clustered.write_clustered(df, path, ("InvoiceNo", "StockCode"), files=16)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).count().collect()]
    assert max(sizes) < 6000 / 4


def _landed_days(spark, n=4):
    path = scratch_path(spark, "days")
    df = spark.range(600).select(F.col("id"), F.lit(2010).alias("year"), F.lit(1).alias("month"), F.when(F.col("id") % 6 != 5, (F.col("id") % 6).cast("int")).alias("day"))
    for i in range(n):
        write_parquet(df.filter(F.col("id") % n == i), path, partition_by=DATE_PARTS, mode="append")
    return path, df


def test_compaction_keeps_rows_and_leaves_few_files(spark):
    path, df = _landed_days(spark)
    before = compact.data_files(spark, path).count()
    done = compact.compact(spark, path)
    assert done["folders"] == 6 and done["files_before"] == before and done["files_after"] == 6
    assert compact.data_files(spark, path).count() == 6
    back = spark.read.parquet(path)
    assert sorted(tuple(r) for r in back.select("id", "day").collect()) == sorted((r.id, r.day) for r in df.collect())
    assert compact.compact(spark, path) == {"folders": 0, "files_before": 0, "files_after": 0}


def test_bins_follow_the_target_size(spark):
    files = [("d", f"f{i}", b) for i, b in enumerate([10, 20, 30, 40, 50, 500])] + [("e", "only", 5), ("g", "x", 500), ("g", "y", 600)]
    packed = compact.packed_files(spark.createDataFrame(files, "folder string, file string, bytes bigint"), 100).collect()
    bins = {}
    for r in packed:
        assert r.folder == "d"  # one file, or big ones only: nothing to gain
        bins.setdefault(r.bin, []).append(r.bytes)
    assert sorted(map(sorted, bins.values())) == [[10, 20, 30, 40], [50], [500]]


def test_a_stopped_swap_is_recovered(spark):
    path, df = _landed_days(spark, 1)
    files = compact._Files(spark, path)
    day = f"{path}/year=2010/month=1/day=2"
    files.move(day, compact._beside(day, compact._ASIDE))  # stopped between the two renames
    assert spark.read.parquet(path).count() == 500
    assert compact.recover(spark, path) == 1
    assert spark.read.parquet(path).count() == 600


@pytest.mark.parametrize("name", ["csv_good_lines", "csv_broken_lines", "manifest_lines", "clustered_lines", "clustered_point_reads"])
def test_registered_queries(spark, sf_small, name):
    import __spark_entry__ as entry

    assert compare_frame(entry.queries()[name](spark, sf_small), entry.oracle_sql()[name], duckdb_connection(sf_small)) == "ok"
