"""Paging by cursor instead of offset.

A page starts after the last row of the page before it. That row's order
columns are the cursor, and "after the cursor" is a lexicographic range
predicate, which reaches the scan. The frame is stored once, range-partitioned
and sorted in the page order, one folder a sorted partition, beside a small
table of each folder's last row; a page picks the one or two folders it needs
from that table. Unlike an offset, a cursor costs the same at any depth, and
rows that appear before it do not shift the pages after it.
"""

from __future__ import annotations

import base64
import decimal
import json
from dataclasses import dataclass
from typing import Any, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators.serving import DEFAULT_PAGE_SIZE, MART_VIEWS, check_page_args
from tillroll.session import materialize, scratch_path

Order = Sequence[tuple[str, bool]]  # (column, descending), the last ones making it total


def mart_order(name: str) -> list[tuple[str, bool]]:
    """The page order of a mart."""
    view = MART_VIEWS[name]
    return [(view.measure, view.descending), *[(k, False) for k in view.keys]]


def _sorted_by(order: Order) -> list[Column]:
    return [F.col(c).desc() if down else F.col(c).asc() for c, down in order]


def after(order: Order, cursor: dict[str, Any], types: dict[str, T.DataType], prefix: str = "") -> Column:
    """Rows strictly after a cursor in the order (nulls first ascending, last
    descending, as Spark sorts them)."""
    found = F.lit(False)
    for name, down in reversed(order):
        col, value = F.col(prefix + name), cursor[name]
        here = F.lit(value).cast(types[name])
        if value is None:
            beyond = F.lit(False) if down else col.isNotNull()
            found = beyond | (col.isNull() & found)
        else:
            beyond = ((col < here) | col.isNull()) if down else (col > here)
            found = beyond | ((col == here) & found)
    return found


def encode_cursor(cursor: dict[str, Any]) -> str:
    """An opaque text for clients; doubles come back bit for bit."""
    plain = {k: {"d": str(v)} if isinstance(v, decimal.Decimal) else v for k, v in cursor.items()}
    return base64.urlsafe_b64encode(json.dumps(plain).encode()).decode()


def decode_cursor(text: str) -> dict[str, Any]:
    try:
        found = json.loads(base64.urlsafe_b64decode(text.encode()))
        return {k: decimal.Decimal(v["d"]) if isinstance(v, dict) else v for k, v in found.items()}
    except (ValueError, KeyError, AttributeError, decimal.InvalidOperation) as exc:
        raise ValueError(f"not a cursor: {text!r}") from exc


@dataclass(frozen=True)
class KeysetView:
    """``rows`` in folders ``_part`` in page order; ``bounds`` has one row a
    folder: its number of rows and its last row's order columns."""

    rows: DataFrame
    bounds: DataFrame
    order: tuple[tuple[str, bool], ...]

    @property
    def columns(self) -> list[str]:
        return [c for c in self.rows.columns if c != "_part"]

    def _types(self) -> dict[str, T.DataType]:
        return {c: self.rows.schema[c].dataType for c, _ in self.order}

    def folders(self, cursor: dict[str, Any] | None, page_size: int) -> list[int]:
        """The folders that hold the page after a cursor: the first with a row
        after it, and more until the page is sure to be full."""
        bounds = self.bounds
        if cursor is not None:
            bounds = bounds.filter(after(self.order, cursor, self._types(), "_last."))
        # Every folder has a row, so these are enough, and at most a page's number.
        near = bounds.orderBy("_part").limit(page_size + 1).select("_part", "_n").collect()
        found, rows = [], 0
        for i, (part, n) in enumerate(near):
            found.append(part)
            rows += n if i or cursor is None else 0  # the cursor may stand anywhere in the first
            if rows >= page_size:
                break
        return found

    def page(self, cursor: dict[str, Any] | None = None, page_size: int = DEFAULT_PAGE_SIZE) -> DataFrame:
        """The first ``page_size`` rows after a cursor (from the start without one)."""
        check_page_args(1, page_size)
        if cursor is not None and set(cursor) != {c for c, _ in self.order}:
            raise ValueError(f"a cursor needs the columns {[c for c, _ in self.order]}, got {sorted(cursor)}")
        rows = self.rows.filter(F.col("_part").isin(self.folders(cursor, page_size)))
        if cursor is not None:
            rows = rows.filter(after(self.order, cursor, self._types()))
        return rows.orderBy(*_sorted_by(self.order)).limit(int(page_size)).select(self.columns)

    def cursor_of(self, row) -> dict[str, Any]:
        return {c: row[c] for c, _ in self.order}

    def response(self, cursor_text: str | None = None, page_size: int = DEFAULT_PAGE_SIZE) -> dict:
        """A page as a plain dict: ``data`` and ``next``, the cursor for the
        following page (none after a page that is not full)."""
        cursor = None if cursor_text is None else decode_cursor(cursor_text)
        rows = self.page(cursor, page_size).collect()  # a page at most
        more = encode_cursor(self.cursor_of(rows[-1])) if len(rows) == page_size else None
        return {"page_size": page_size, "data": [r.asDict() for r in rows], "next": more}


def keyset_view(df: DataFrame, order: Order, name: str = "keyset", partitions: int | None = None) -> KeysetView:
    """Store a frame for paging by cursor. ``order`` must be total: rows equal
    in all its columns would be skipped after a page that ends between them.

    ``partitions`` fixes the number of folders; otherwise it follows the
    session's shuffle settings.
    """
    spark = df.sparkSession
    cols = _sorted_by(order)
    dealt = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    sorted_parts = dealt.withColumn("_part", F.spark_partition_id()).sortWithinPartitions("_part", *cols)
    # The low 33 bits of the id are the row's place in its task, so in the order.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    tagged = sorted_parts.withColumn("_pos", place)
    path = scratch_path(spark, f"{name}-rows")
    tagged.write.mode("overwrite").partitionBy("_part").parquet(path)
    rows = spark.read.schema(tagged.schema).parquet(path)
    last = F.max_by(F.struct(*[c for c, _ in order]), "_pos").alias("_last")
    bounds = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), last)
    return KeysetView(rows.drop("_pos"), materialize(bounds, f"{name}-bounds"), tuple(order))
