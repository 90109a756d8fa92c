"""CSV text with quotes, commas, backslashes and line breaks, and file headers."""

import os

import pytest

from tillroll.plans import bronze, silver
from tillroll.plans.split import split_job
from tillroll.schemas import FLAT_EXTRACT, LINES_RAW
from tillroll.session import scratch_dir
from tillroll.sources import extracts
from tillroll.sources.sinks import write_csv

HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
ODD = ['CHARLIE+LOLA"EXTREMELY BUSY" SIGN', 'SIGN "X", BLUE', "two\nlines", "back\\slash", " padded "]


def _write(path, descriptions):
    with open(path, "w", encoding="latin-1") as out:
        out.write(",".join(f.name for f in FLAT_EXTRACT.fields) + "\n")
        for i, d in enumerate(descriptions):
            quoted = '"' + d.replace('"', '""') + '"'
            values = {"InvoiceNo": str(i), "StockCode": "A", "Description": quoted, "Quantity": "3", "InvoiceDate": "12/1/2009 7:45", "UnitPrice": "1.5", "CustomerID": "", "Country": "France"}
            out.write(",".join(values[f.name] for f in FLAT_EXTRACT.fields) + "\n")


def test_quoted_text_survives_read_split_and_ingest(spark, tmp_path):
    path = str(tmp_path / "a.csv")
    _write(path, ODD)
    rows = extracts.read_latin1_csv(spark, path, schema=FLAT_EXTRACT).collect()
    assert sorted(r["Description"] for r in rows) == sorted(ODD) and all(r["Quantity"] == 3 for r in rows)
    before = set(os.listdir(_scratch(spark)))
    out = split_job(spark, [path], str(tmp_path / "split"))
    assert set(os.listdir(_scratch(spark))) == before
    products = extracts.read_csv(spark, out["products"], schema=bronze.DEFAULT_SCHEMAS["products"])
    assert sorted(r["Description"] for r in products.collect()) == sorted(ODD)


def _scratch(spark):
    root = os.path.join(scratch_dir(spark).removeprefix("file:"), "tillroll")
    os.makedirs(root, exist_ok=True)
    return root


def test_header_in_another_order_fails(spark, tmp_path):
    (tmp_path / "1.csv").write_text("InvoiceNo,StockCode,Quantity\nI1,A,1\n")
    (tmp_path / "2.csv").write_text("StockCode,InvoiceNo,Quantity\nB,I2,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        extracts.read_csv(spark, str(tmp_path), schema=LINES_RAW).collect()
    one = extracts.read_csv(spark, str(tmp_path / "2.csv"), schema=LINES_RAW).collect()
    assert [tuple(r) for r in one] == [("I2", "B", 2)]


def test_writer_and_reader_share_a_dialect(spark, tmp_path):
    df = spark.createDataFrame([(str(i), d, i) for i, d in enumerate(ODD)], LINES_RAW)
    write_csv(df, str(tmp_path / "out"))
    back = extracts.read_csv(spark, str(tmp_path / "out"), schema=LINES_RAW)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_orders_without_rows(spark, tmp_path):
    names = {"orders": "InvoiceNo,InvoiceDate,CustomerID,Country", "products": "StockCode,Description,UnitPrice", "orders_line": "InvoiceNo,StockCode,Quantity"}
    for name, header in names.items():
        (tmp_path / f"{name}.csv").write_text(header + "\n")
    bronze.ingest(spark, bronze.standard_specs(str(tmp_path), str(tmp_path / "b")))
    b = tmp_path / "b"
    layers = silver.layers_from_bronze(spark, str(b / "products_partitioned"), str(b / "orders_partitioned"), str(b / "orders_line"))
    assert layers.orders.count() == 0 and layers.lines.count() == 0


def test_stream_needs_a_checkpoint():
    from tillroll.streaming.ingest import ingest_stream

    with pytest.raises(TypeError):
        ingest_stream(None, None)


def test_a_large_file_without_line_breaks_is_read_by_many_tasks(spark, tmp_path):
    path = tmp_path / "lines.csv"
    path.write_text("InvoiceNo,StockCode,Quantity\n" + "".join(f"{i},a,1\n" for i in range(40_000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        tasks = {m: extracts.read_csv(spark, str(path), schema=LINES_RAW, multi_line=m).rdd.getNumPartitions() for m in (True, False)}
        assert tasks[True] == 1 and tasks[False] >= 4
        assert extracts.read_csv(spark, str(path), schema=LINES_RAW, multi_line=False).count() == 40_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    specs = {s.name: s.multi_line for s in bronze.standard_specs("in", "out")}
    assert specs == {"orders_line": False, "orders": True, "products": True}
    assert not any(s.multi_line for s in bronze.standard_specs("in", "out", multi_line=False))
