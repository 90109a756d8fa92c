"""Extract files: CSV reads and the split of yearly extracts into datasets.

CSV is read with a declared schema by default (``infer=True`` reproduces the
header-and-inference read). Headers are normalised, so a first column named
with a byte order mark, in either its UTF-8 or its ISO-8859-1-decoded form,
still comes out as ``InvoiceNo``.

The split job turns flat yearly extracts (one row per invoice line with every
attribute repeated) into the three datasets the ingest expects:

* products - distinct (StockCode, Description, UnitPrice)
* orders   - distinct (InvoiceNo, InvoiceDate, CustomerID, Country)
* lines    - (InvoiceNo, StockCode, Quantity), duplicates kept

``distinct`` is a hash aggregate with a map-side partial step, so repeated
rows collapse inside each task before anything is shuffled.
"""

from __future__ import annotations

import functools
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.text import normalise_headers

# Fixed value: encoding of the yearly extracts.
LATIN_1 = "ISO-8859-1"

# Quotes inside quoted text are doubled, and backslashes are plain text.
DIALECT = {"quote": '"', "escape": '"'}

PRODUCT_COLUMNS = ["StockCode", "Description", "UnitPrice"]
ORDER_COLUMNS = ["InvoiceNo", "InvoiceDate", "CustomerID", "Country"]
LINE_COLUMNS = ["InvoiceNo", "StockCode", "Quantity"]


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | None = None,
    infer: bool = False,
    encoding: str = "UTF-8",
    multi_line: bool = True,
) -> DataFrame:
    """Header CSV with normalised column names; quotes inside quoted text are
    doubled. All files must have the first file's header, else reading fails.

    ``multi_line`` allows line breaks inside quoted text and reads each file in
    one task; turn it off for large files known to have none.

    With ``schema`` the columns are read as text and converted to the
    declared types (a malformed value becomes NULL, as in a permissive read),
    matched by their normalised header names. Without a
    schema, ``infer`` chooses between inferred types and all-text columns.
    """
    reader = (
        spark.read.option("header", True)
        .option("encoding", encoding)
        .option("inferSchema", bool(infer) and schema is None)
        .option("multiLine", multi_line)
        .options(**DIALECT)
    )
    raw = reader.csv(paths)
    if schema is None:
        return normalise_headers(raw)
    # Declared as text in file order, and checked against every file's header.
    checked = reader.option("inferSchema", False).option("enforceSchema", False).schema(text_schema(raw.schema))
    df = normalise_headers(checked.csv(paths))
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"CSV header lacks columns {missing}; found {df.columns}")
    return apply_schema(df, schema)


def apply_schema(text_columns: DataFrame, schema: T.StructType) -> DataFrame:
    """Convert text columns (named as in ``schema``) to the declared types."""
    return text_columns.select([typed_column(f.name, f.dataType).alias(f.name) for f in schema.fields])


def text_schema(schema: T.StructType) -> T.StructType:
    """The same column names, all as text."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def typed_column(name: str, data_type: T.DataType) -> Column:
    """Text to ``data_type``; NULL when the text does not fit.

    Integer columns also accept whole numbers written with a decimal part
    (``12.0``), as a tool writes an integer column that has missing values.
    """
    text = F.col(name)
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        number = text.try_cast("double")
        whole = F.when(number == F.floor(number), number)
        return F.coalesce(text.try_cast(data_type), whole.try_cast(data_type))
    return text.try_cast(data_type)


def read_latin1_csv(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None, multi_line: bool = True
) -> DataFrame:
    """The yearly extracts are ISO-8859-1 encoded. Without ``multi_line`` large
    files are read by many tasks."""
    return read_csv(spark, paths, schema=schema, encoding=LATIN_1, infer=schema is None, multi_line=multi_line)


def concat_extracts(*extracts: DataFrame) -> DataFrame:
    """Stack extracts by column name, keeping duplicates (no shuffle)."""
    return functools.reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [normalise_headers(e) for e in extracts]
    )


def split_products(flat: DataFrame) -> DataFrame:
    return flat.select(*PRODUCT_COLUMNS).distinct()


def split_orders(flat: DataFrame) -> DataFrame:
    return flat.select(*ORDER_COLUMNS).distinct()


def split_lines(flat: DataFrame) -> DataFrame:
    return flat.select(*LINE_COLUMNS)


def split_extracts(*extracts: DataFrame) -> dict[str, DataFrame]:
    """The three datasets from one or more flat extracts."""
    flat = concat_extracts(*extracts)
    return {
        "products": split_products(flat),
        "orders": split_orders(flat),
        "orders_line": split_lines(flat),
    }
