"""Suffix-array dedup: repeated byte strings by common-prefix interval trees.

The runs that share a minimiser (see ``repeats``) are aligned at it. Per group
an enhanced suffix array is built over the suffixes that begin at the
minimiser: the suffixes sorted, and the longest common prefix (LCP) of
neighbours. A stack scan over the LCP values yields the intervals of the
common-prefix tree, each holding *all* suffixes that share a prefix. Inside an
interval the texts to the left are sorted backwards and scanned by the same
stack, which tests how the left extensions branch: a tree node (l, r) whose
members disagree both before their ``l`` left symbols and after their ``r``
right symbols is a maximal repeat of length ``l + r`` with all its occurrences.
Nodes shorter than the window are never opened.

Repeats are maximal inside a run; a longer repeat spans several runs, and its
covered stretches join again in the text they belong to.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm import textkit
from tillroll.llm.repeats import RepeatSpec, _contexts, _minimisers, join_hot, key_slabs, remove_repeats, repeat_frames

WINDOW_BYTES = 200
GRAM_BYTES = 40


def prefix_intervals(lcp: np.ndarray, floor: int) -> Iterator[tuple[int, int, int]]:
    """``(value, first, last)`` of every interval of the common-prefix tree
    with value >= ``floor``; ``lcp[i]`` compares items ``i`` and ``i + 1``."""
    stack: list[tuple[int, int]] = []
    values = lcp.tolist()
    for i, value in enumerate([*values, -1]):
        begin = i
        while stack and stack[-1][0] > value:
            top, begin = stack.pop()
            yield top, begin, i
        if value >= floor and (not stack or stack[-1][0] < value):
            stack.append((value, begin))


def _matrix(parts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of byte values plus one, padded with zeros (UTF-8 has no 0xFF) to
    ``width``, and their lengths."""
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    out = np.frombuffer(b"".join(p.ljust(width, b"\xff") for p in parts), np.uint8).reshape(len(parts), width)
    return out + np.uint8(1), lengths


def _common(a: np.ndarray, b: np.ndarray, la: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """Length of the common prefix of row pairs."""
    differ = a != b
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])
    return np.minimum(first, np.minimum(la, lb))


def _sort_rows(matrix: np.ndarray) -> np.ndarray:
    if matrix.shape[1] == 0:
        return np.arange(len(matrix))
    return np.argsort(np.ascontiguousarray(matrix).view(f"S{matrix.shape[1]}").ravel(), kind="stable")


class _Slab:
    """The aligned runs of whole groups: right and reversed left parts."""

    def __init__(self, slab: pa.Table, spec: RepeatSpec):
        ctx = slab.column("ctx").to_pylist()
        self.off = (slab.column("at").to_numpy() & 255).astype(np.int64)
        self.window, self.gram = spec.window, spec.gram
        h = slab.column("h").to_numpy()
        self.right, self.n_right = _matrix([c[o:] for c, o in zip(ctx, self.off.tolist())], spec.window)
        self.left, self.n_left = _matrix([c[:o][::-1] for c, o in zip(ctx, self.off.tolist())], spec.window - spec.gram)
        key = h.astype(">i8").view(np.uint8).reshape(-1, 8)
        self.order = _sort_rows(np.hstack([key, self.right]))
        a, b = self.order[:-1], self.order[1:]
        same = h[a] == h[b]
        self.lcp = np.where(same, _common(self.right[a], self.right[b], self.n_right[a], self.n_right[b]), 0)

    def repeats(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """``(l, r, rows)`` of every maximal repeat of at least a window."""
        for r, i, j in prefix_intervals(self.lcp, self.gram):
            rows = self.order[i : j + 1]
            need = self.window - r
            if int(np.partition(self.n_left[rows], -2)[-2]) < need:
                continue
            by_left = rows[_sort_rows(self.left[rows])]
            a, b = by_left[:-1], by_left[1:]
            common = _common(self.left[a], self.left[b], self.n_left[a], self.n_left[b])
            if int(common.max()) < need:
                continue
            rank = None
            for l, x, y in prefix_intervals(common, max(need, 0)):
                members = by_left[x : y + 1]
                if len(members) < len(rows):
                    # right diversity: the members must not share a longer prefix
                    if rank is None:
                        rank = np.empty(len(self.order), np.int64)
                        rank[rows] = np.arange(len(rows))
                    span = np.sort(rank[members])
                    if int(self.lcp[i + span[0] : i + span[-1]].min()) > r:
                        continue
                yield l, r, members


def covered_by_suffixes(slab: pa.Table, spec: RepeatSpec) -> tuple[np.ndarray, np.ndarray]:
    """Per run the stretch covered by its maximal repeats. All of them contain
    the run's minimiser, so their union is one stretch."""
    work = _Slab(slab, spec)
    most_left = np.full(len(work.off), -1, np.int64)
    most_right = np.zeros(len(work.off), np.int64)
    for l, r, rows in work.repeats():
        most_left[rows] = np.maximum(most_left[rows], l)
        most_right[rows] = np.maximum(most_right[rows], r)
    hit = most_left >= 0
    return np.where(hit, work.off - most_left, 0), np.where(hit, work.off + most_right, 0)


def spec_for(window: int = WINDOW_BYTES, gram: int = GRAM_BYTES, hot_group: int = 1 << 16) -> RepeatSpec:
    return RepeatSpec("bytes", window, gram, hot_group)


def remove_repeated_bytes(docs: DataFrame, text_col: str = "text", spec: RepeatSpec | None = None) -> DataFrame:
    """Cut every byte covered by a repeated ``window``-byte string.

    ``kept`` holds the remaining bytes (cutting may split a UTF-8 sequence, so
    they are binary), ``removed`` the maximal removed byte runs. Null text is
    empty; empty tables give empty results; texts of any length are handled
    whole; repeated rows and exact copies remove each other; other columns
    pass through, but for those named like a result column.
    """
    return remove_repeats(docs, text_col, spec or spec_for(), covered_by_suffixes)


def _groups(batches: Iterator[pa.RecordBatch], spec: RepeatSpec) -> Iterator[pa.RecordBatch]:
    for slab in key_slabs(batches, "h", spec.slab_rows):
        # a context met more than once stands twice, so that it repeats itself
        own = np.repeat(np.arange(slab.num_rows), np.minimum(slab.column("n").to_numpy(), 2))
        work = _Slab(slab.take(pa.array(own)), spec)
        h, c1, c2 = (slab.column(c).to_numpy() for c in ("h", "c1", "c2"))
        seen: dict[int, int] = {}
        for l, r, members in work.repeats():
            rows = np.unique(own[members])
            key = int(h[rows[0]])
            seen[key] = seen.get(key, 0) + 1
            yield pa.RecordBatch.from_pydict(
                {
                    "h": h[rows],
                    "repeat": np.full(len(rows), seen[key]),
                    "length": np.full(len(rows), l + r),
                    "l": np.full(len(rows), l),
                    "c1": c1[rows],
                    "c2": c2[rows],
                }
            )


def _digests(parts: list[bytes]) -> np.ndarray:
    joined = b"".join(hashlib.blake2b(p, digest_size=16).digest() for p in parts)
    return np.frombuffer(joined, np.int64).reshape(-1, 2)


def _prefixes(batches: Iterator[pa.RecordBatch], spec: RepeatSpec) -> Iterator[pa.RecordBatch]:
    """Every right prefix of a context that may end a repeat, and the symbol after it (-1 at the end)."""
    for batch in batches:
        for h, at, ctx, n, c1, c2 in zip(*(batch.column(c).to_pylist() for c in ("h", "at", "ctx", "n", "c1", "c2"))):
            right = ctx[at & 255 :]
            r = np.arange(spec.gram, len(right) + 1)
            d = _digests([b"%d %d " % (h, x) + right[:x] for x in r.tolist()])
            beyond = [*right[spec.gram :], -1]
            yield pa.RecordBatch.from_pydict(
                {"d1": d[:, 0].copy(), "d2": d[:, 1].copy(), "r": r, "after": pa.array(beyond, pa.int64())}
                | {k: np.full(len(r), v) for k, v in (("n", n), ("c1", c1), ("c2", c2))}
            )


def _nodes(batches: Iterator[pa.RecordBatch], spec: RepeatSpec) -> Iterator[pa.RecordBatch]:
    """Every string around the minimiser of at least a window that ends where right sides branch."""
    for batch in batches:
        for h, at, ctx, n, c1, c2, ends in zip(*(batch.column(c).to_pylist() for c in ("h", "at", "ctx", "n", "c1", "c2", "ends"))):
            left, right = ctx[: at & 255][::-1], ctx[at & 255 :]
            pairs = [(l, r) for r in ends for l in range(max(spec.window - r, 0), len(left) + 1)]
            if not pairs:
                continue
            d = _digests([b"%d %d %d " % (h, l, r) + left[:l] + right[:r] for l, r in pairs])
            yield pa.RecordBatch.from_pydict(
                {
                    "d1": d[:, 0].copy(),
                    "d2": d[:, 1].copy(),
                    "h": np.full(len(pairs), h),
                    "length": pa.array([l + r for l, r in pairs], pa.int64()),
                    "l": pa.array([l for l, _ in pairs], pa.int64()),
                    "before": pa.array([left[l] if l < len(left) else -1 for l, _ in pairs], pa.int64()),
                    "after": pa.array([right[r] if r < len(right) else -1 for _, r in pairs], pa.int64()),
                    "n": np.full(len(pairs), n),
                    "c1": np.full(len(pairs), c1),
                    "c2": np.full(len(pairs), c2),
                }
            )


def _diverse(column: str) -> Column:
    """Whether the members disagree in a symbol; an end agrees with nothing."""
    return (F.min(column) < 0) | (F.min(column) < F.max(column))


def _hot_repeats(contexts: DataFrame, spec: RepeatSpec) -> DataFrame:
    """The repeats of ``_groups`` where a group has too many different contexts
    for one task: the common-prefix tree by counts of digested strings."""
    prefixes = contexts.mapInArrow(
        lambda it: _prefixes(it, spec), "d1 bigint, d2 bigint, r bigint, after bigint, n bigint, c1 bigint, c2 bigint"
    )
    branching = prefixes.groupBy("d1", "d2").agg(F.sum("n").alias("_n"), _diverse("after").alias("_ok")).filter("_n > 1 AND _ok")
    ends = join_hot(prefixes, branching.select("d1", "d2"), ["d1", "d2"]).groupBy("c1", "c2").agg(F.collect_list("r").alias("ends"))
    nodes = contexts.join(ends, ["c1", "c2"]).mapInArrow(
        lambda it: _nodes(it, spec),
        "d1 bigint, d2 bigint, h bigint, length bigint, l bigint, before bigint, after bigint, n bigint, c1 bigint, c2 bigint",
    )
    maximal = (
        nodes.groupBy("d1", "d2")
        .agg(F.sum("n").alias("_n"), (_diverse("before") & _diverse("after")).alias("_ok"))
        .filter("_n > 1 AND _ok")
        .select("d1", "d2")
    )
    return join_hot(nodes, maximal, ["d1", "d2"]).select("h", F.col("d1").alias("repeat"), "length", "l", "c1", "c2")


def maximal_repeats(docs: DataFrame, text_col: str = "text", spec: RepeatSpec | None = None) -> DataFrame:
    """All occurrences of every maximal repeat inside the runs.

    One row per occurrence in each row of ``docs``, exact copies included: the
    repeat's id (``h``, ``repeat``), its length, the key of the text, the first
    byte and ``doc`` (the row's other columns). Equal contexts of a minimiser
    are compared once; a minimiser with more than ``hot_group`` different ones
    is counted by digests instead of going to one task.
    """
    spec = spec or spec_for()
    frames = repeat_frames(docs, text_col, spec, covered_by_suffixes)
    texts = frames.texts
    # Unlike for removal, a minimiser met in the copies of one text alone counts.
    placed = texts.mapInArrow(lambda it: _minimisers(it, spec, True), "h bigint, k1 bigint, k2 bigint, at bigint")
    copied = texts.filter("copies > 1").select("k1", "k2", F.lit(2).cast("bigint").alias("n"))
    weighed = placed.join(copied, ["k1", "k2"], "left").withColumn("n", F.coalesce("n", F.lit(1).cast("bigint")))
    counts = weighed.groupBy("h").agg(F.sum("n").alias("_n")).filter("_n > 1").select("h")
    hits = (
        join_hot(placed, counts, ["h"])
        .groupBy("k1", "k2")
        .agg(F.collect_list(F.struct("h", "at", F.lit(False).alias("hot"))).alias("hits"))
    )
    runs = texts.join(hits, ["k1", "k2"]).mapInArrow(
        lambda it: _contexts(it, spec, False), "h bigint, k1 bigint, k2 bigint, at bigint, ctx binary"
    )
    off = F.col("at").bitwiseAND(F.lit(255))
    keyed = runs.withColumns({"c1": F.xxhash64("h", off, "ctx"), "c2": F.xxhash64(F.lit(29), "h", off, "ctx")})
    contexts = (
        keyed.join(copied, ["k1", "k2"], "left")
        .select("h", off.alias("at"), "ctx", "c1", "c2", F.coalesce("n", F.lit(1).cast("bigint")).alias("n"))
        .groupBy("h", "at", "ctx", "c1", "c2")
        .agg(F.sum("n").alias("n"))
    )
    groups = contexts.groupBy("h").agg((F.count(F.lit(1)) > spec.hot_group).alias("hot"))
    sized = join_hot(contexts, groups, ["h"])
    cold = (
        sized.filter("NOT hot")
        .repartition("h")
        .sortWithinPartitions("h")
        .mapInArrow(lambda it: _groups(it, spec), "h bigint, repeat bigint, length bigint, l bigint, c1 bigint, c2 bigint")
    )
    found = cold.unionByName(_hot_repeats(sized.filter("hot").drop("hot"), spec))
    return (
        found.join(keyed.select("c1", "c2", "k1", "k2", "at"), ["c1", "c2"])
        .join(frames.keyed, ["k1", "k2"])
        .select("h", "repeat", "length", "k1", "k2", (F.shiftright("at", 16) + off - F.col("l")).alias("start"), "doc")
    )
