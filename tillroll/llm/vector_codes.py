"""Vector code compression: product codebooks searched by equal averages.

Vectors are scaled to integers and cut into equal parts; every part position
has a codebook of a few dozen entries. All arithmetic is on integers, so the
result does not depend on how rows are dealt out.

Search. An entry's squared distance to a part is at least the square of the
gap between their component sums, divided by the number of components. Entries
are sorted by component sum; from a part's own sum the search goes outward to
both sides, nearest sum first, and ends once the squared gap exceeds the best
distance times the width (strictly, so that an equally near entry of a lower
index is still met). A slice of parts takes each step together; parts that
have ended leave the slice.

Training. Each round is one pass: a task adds its parts up by entry and hands
on one row per component of a used entry, which are summed by entry. Only the
codebooks, whose size does not depend on the table, visit the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_VALUES = 1 << 19  # components handled at a time
_HEX = np.frombuffer("".join(f"{i:02x}" for i in range(256)).encode(), np.uint8).reshape(256, 2)


@dataclass(frozen=True)
class CodeSpec:
    """``parts`` equal parts a vector, ``entries`` (256 at most) a codebook."""

    parts: int = 16
    entries: int = 64
    scale: int = 256
    rounds: int = 2

    def __post_init__(self) -> None:
        if min(self.parts, self.entries, self.scale) < 1 or self.entries > 256 or self.rounds < 0:
            raise ValueError("need parts, scale >= 1, 1 <= entries <= 256 and rounds >= 0")


@dataclass(frozen=True)
class Codebooks:
    """``values[part, entry, place]``, integers after scaling."""

    values: np.ndarray
    spec: CodeSpec

    @property
    def dimension(self) -> int:
        return self.values.shape[0] * self.values.shape[2]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.values.ravel().tolist())).encode()).hexdigest()

    def decode(self, code: str) -> np.ndarray:
        """The vector a code stands for: every part's entry, at the middle of its step."""
        picks = np.frombuffer(bytes.fromhex(code), np.uint8)
        return (self.values[np.arange(len(picks)), picks].ravel() + 0.5) / self.spec.scale


def nearest_entries(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(index, squared distance)`` of every row's nearest entry; a tie goes
    to the lower index. Both arguments are integer matrices of equal width."""
    n, width = parts.shape
    sums = entries.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    sums, entries, last = sums[order], entries[order], len(order) - 1
    own = parts.sum(axis=1)
    best, index = np.full(n, np.iinfo(np.int64).max), np.full(n, -1, np.int64)
    rows = np.arange(n)
    above = np.searchsorted(sums, own)  # the next entry on either side
    below = above - 1
    while len(rows):
        down = own - sums[np.maximum(below, 0)]
        up = sums[np.minimum(above, last)] - own
        lower = (above > last) | ((below >= 0) & (down <= up))
        gap = np.where(lower, down, up)
        # the first step always goes on: no best distance is known yet
        limit = np.where(index[rows] < 0, np.iinfo(np.int64).max, np.minimum(best[rows], (1 << 62) // width) * width)
        go = ((below >= 0) | (above <= last)) & (gap * gap <= limit)
        if not go.all():
            rows, own, above, below, lower = rows[go], own[go], above[go], below[go], lower[go]
        at = np.where(lower, below, above)
        apart = parts[rows] - entries[at]
        far = np.einsum("ij,ij->i", apart, apart)
        found, known = order[at], best[rows]
        better = (far < known) | ((far == known) & (found < index[rows]))
        best[rows[better]], index[rows[better]] = far[better], found[better]
        below, above = below - lower, above + ~lower
    return index, best


def _scaled(column: pa.Array, dimension: int, spec: CodeSpec) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(rows, integer matrix)`` of the usable vectors, slice by slice."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    starts = np.cumsum(np.maximum(lengths, 0)) - np.maximum(lengths, 0)
    values = (flat.fill_null(np.nan) if flat.null_count else flat).to_numpy(zero_copy_only=False)
    fit = np.flatnonzero(lengths == dimension)
    step = max(SLICE_VALUES // dimension, 1)
    bound = (1 << 30) // (dimension // spec.parts)  # keeps all sums and squares within 64 bits
    for lo in range(0, len(fit), step):
        rows = fit[lo : lo + step]
        wide = values[starts[rows][:, None] + np.arange(dimension)].astype(np.float64)
        whole = np.isfinite(wide).all(axis=1)
        rows, wide = rows[whole], np.floor(wide[whole] * spec.scale)
        if np.abs(wide).max(initial=0) >= bound:
            raise ValueError(f"a scaled component is beyond {bound}, the largest that is added up exactly")
        if len(rows):
            yield rows, wide.astype(np.int64)


def _sums(batches: Iterator[pa.RecordBatch], books: Codebooks) -> Iterator[pa.RecordBatch]:
    """How many parts each entry has, and their sums by place."""
    parts, entries, width = books.values.shape
    total, count = np.zeros(books.values.shape, np.int64), np.zeros((parts, entries), np.int64)
    for batch in batches:
        for _, ints in _scaled(batch.column("vector"), books.dimension, books.spec):
            for p in range(parts):
                part = ints[:, p * width : (p + 1) * width]
                index, _ = nearest_entries(part, books.values[p])
                np.add.at(total[p], index, part)
                count[p] += np.bincount(index, minlength=entries)
    used = np.repeat(count.ravel(), width)
    slots = np.flatnonzero(used)
    yield pa.RecordBatch.from_arrays(
        [pa.array(slots.astype(np.int64)), pa.array(used[slots]), pa.array(total.ravel()[slots])], ["slot", "n", "total"]
    )


def _codes(batches: Iterator[pa.RecordBatch], books: Codebooks, passed: list[str]) -> Iterator[pa.RecordBatch]:
    parts, _, width = books.values.shape
    for batch in batches:
        for rows, ints in _scaled(batch.column("vector"), books.dimension, books.spec):
            code, error = np.empty((len(rows), parts), np.uint8), np.zeros(len(rows), np.int64)
            for p in range(parts):
                code[:, p], far = nearest_entries(ints[:, p * width : (p + 1) * width], books.values[p])
                error += far
            ends = np.arange(len(rows) + 1, dtype=np.int32) * 2 * parts
            text = pa.StringArray.from_buffers(len(rows), pa.py_buffer(ends), pa.py_buffer(_HEX[code].tobytes()))
            kept = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*[kept.column(c) for c in passed], text, pa.array(error)], [*passed, "code", "error"])


def _usable(vectors: DataFrame, vector_col: str, spec: CodeSpec) -> DataFrame:
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    size = F.size("vector")
    return vectors.filter((size > 0) & (size % spec.parts == 0) & finite)


def _vectors(vectors: DataFrame, vector_col: str, **others: str) -> DataFrame:
    kind = vectors.schema[vector_col].dataType
    column = F.col(vector_col)
    if not isinstance(kind.elementType, (T.FloatType, T.DoubleType)):
        column = column.cast("array<double>")
    return vectors.select(column.alias("vector"), *[F.col(c).alias(name) for name, c in others.items()])


def train(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", spec: CodeSpec = CodeSpec()) -> Codebooks | None:
    """Codebooks of all usable vectors of a table; ``None`` if it has none.

    The first entries are the parts of the vectors with the smallest ids
    (null ids last, equal ids by vector; fewer entries if there are fewer
    vectors). Each round assigns every part to its nearest entry and moves the
    entry to the floored mean of its parts; an unused entry stays. A vector is
    usable if it and its components are neither null nor NaN nor infinite and
    its length is that of the first usable one, a multiple of ``parts``.
    Repeated rows count each time. A scaled component of 2**30 divided by the
    part's width, or more, is an error.
    """
    rows = _vectors(vectors, vector_col, id=id_col)
    whole = _usable(rows, "vector", spec).orderBy(F.asc_nulls_last("id"), "vector")
    first = [r["vector"] for r in whole.select("vector", "id").limit(spec.entries).collect()]
    if not first:
        return None
    dimension = len(first[0])
    if any(len(v) != dimension for v in first):
        alike = whole.filter(F.size("vector") == dimension)
        first = [r["vector"] for r in alike.select("vector", "id").limit(spec.entries).collect()]
    seeds = np.concatenate([x for _, x in _scaled(pa.array(first, pa.list_(pa.float64())), dimension, spec)])
    values = np.ascontiguousarray(seeds.reshape(len(seeds), spec.parts, -1).transpose(1, 0, 2))
    for _ in range(spec.rounds):
        books = Codebooks(values, spec)
        sums = rows.select("vector").mapInArrow(lambda it, b=books: _sums(it, b), "slot bigint, n bigint, total bigint")
        moved = values.ravel().copy()
        for slot, n, total in sums.groupBy("slot").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
            moved[slot] = total // n
        values = moved.reshape(values.shape)
    return Codebooks(values, spec)


def encode(
    vectors: DataFrame, books: Codebooks | None, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """``id_col``, ``label_col``, ``code`` (two hex digits a part) and ``error``
    (squared distance to the entries) of every usable vector; other columns
    are not used, other vectors give no row."""
    rows = _vectors(vectors, vector_col, id=id_col, label=label_col)
    out = T.StructType([rows.schema["id"], rows.schema["label"], *T.StructType.fromDDL("code string, error bigint").fields])
    if books is None:
        found = rows.sparkSession.createDataFrame([], out)
    else:
        found = rows.mapInArrow(lambda it: _codes(it, books, ["id", "label"]), out)
    return found.select(F.col("id").alias(id_col), F.col("label").alias(label_col), "code", "error")


def with_label_error(coded: DataFrame, label_col: str = "label") -> DataFrame:
    """``label_error``: ``error`` summed over the rows of equal label (nulls
    are equal). The sums are joined under a struct of the label: both sides
    are then shuffled for the join, so adaptive execution can split a label
    with a large share of all rows."""
    rows = coded.withColumn("_label", F.struct(F.col(label_col).alias("l")))
    sums = coded.groupBy(label_col).agg(F.sum("error").alias("label_error"))
    sums = sums.select(F.struct(F.col(label_col).alias("l")).alias("_label"), "label_error")
    return rows.join(sums, "_label").drop("_label")
