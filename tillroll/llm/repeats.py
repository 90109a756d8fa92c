"""Removal of long repeated passages, shared by the byte and the word operator.

A *symbol* is a byte or a word. A window is ``window`` consecutive symbols of
one text; every symbol covered by a window whose content starts anywhere else
(the same text included, overlaps included) is removed. All windows are
judged on the input.

Partitioning. A window's minimiser - the leftmost least hash among its grams
of ``gram`` symbols - depends on its content alone, so equal windows meet
under one minimiser. Consecutive windows with one minimiser form a run, and
only the runs travel, each with the text it spans:

1. exact copies collapse by a 128-bit text key (map-side partial aggregate);
2. the minimisers of all distinct texts are counted (partial aggregate), and
   those met once are dropped: their windows cannot repeat;
3. the surviving runs are cut from the texts and grouped by minimiser, where a
   *solver* (suffix array or phrase automaton) finds the exact repeats;
4. the covered stretches return to their texts.

A minimiser with more than ``hot_group`` runs does not go to one task: its
windows are counted one by one under their own 128-bit digests with a map-side
aggregate and joined back. Nothing is capped; both ways are exact. Text moves
through one shuffle by text key that every later step shares.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm import textkit

# (contexts, places) of one slab, group by group -> covered [start, stop) per row or -1
Solver = Callable[[pa.Table], tuple[np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class RepeatSpec:
    """``unit`` is ``bytes`` or ``words``; ``gram`` < ``window`` symbols. Kept
    words are joined by one space; with ``keep_layout`` the kept stretches keep
    their white space, and a text that loses nothing stays as it is."""

    unit: str
    window: int
    gram: int
    hot_group: int = 1 << 16
    slab_rows: int = 1 << 13
    keep_layout: bool = False

    def __post_init__(self) -> None:
        if self.unit not in ("bytes", "words"):
            raise ValueError(f"unit must be bytes or words, got {self.unit!r}")
        if not 1 <= self.gram < self.window or self.window - self.gram + 1 > 256:
            raise ValueError("need 1 <= gram < window and at most 256 grams in a window")


@dataclass
class _Symbols:
    """The symbols of a slice of rows: their values, byte spans and rows."""

    values: np.ndarray
    first: np.ndarray  # index of each row's first symbol, one entry more than rows
    starts: np.ndarray | None
    ends: np.ndarray | None

    def span(self, lo: int, hi: int) -> tuple[int, int]:
        if self.starts is None:
            return lo, hi
        return int(self.starts[lo]), int(self.ends[hi - 1])


def symbols_of(data: np.ndarray, offsets: np.ndarray, unit: str) -> _Symbols:
    if unit == "bytes":
        return _Symbols(data, offsets, None, None)
    starts, ends, first = textkit.word_spans(data, offsets, textkit.SPACES)
    return _Symbols(textkit.span_hashes(data, starts, ends) if len(starts) else np.zeros(0, np.uint64), first, starts, ends)


def _runs(symbols: _Symbols, spec: RepeatSpec):
    grams = textkit.gram_hashes(symbols.values, spec.gram)
    lo, hi, place = textkit.window_runs(grams, symbols.first[1:], None, spec.window, spec.gram)
    row = np.searchsorted(symbols.first, lo, side="right") - 1
    at = ((lo - symbols.first[row]) << 16) | ((hi - lo) << 8) | (place - lo)
    return row, grams[place].view(np.int64), at


def _minimisers(batches: Iterator[pa.RecordBatch], spec: RepeatSpec, with_place: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = textkit.column_bytes(batch.column("text"))
        k1, k2 = batch.column("k1").to_numpy(), batch.column("k2").to_numpy()
        for lo, hi in textkit.row_slices(offsets):
            base = offsets[lo]
            row, h, at = _runs(symbols_of(data[base : offsets[hi]], offsets[lo : hi + 1] - base, spec.unit), spec)
            if not len(h):
                continue
            out = {"h": h}
            if with_place:
                out |= {"k1": k1[lo + row], "k2": k2[lo + row], "at": at}
            yield pa.RecordBatch.from_pydict(out)


def _contexts(batches: Iterator[pa.RecordBatch], spec: RepeatSpec, hot: bool) -> Iterator[pa.RecordBatch]:
    """The runs of one kind with the bytes they span; a hot run comes as one
    row for each of its windows, under the window's digest."""
    for batch in batches:
        data, offsets = textkit.column_bytes(batch.column("text"))
        k1, k2 = batch.column("k1").to_numpy(), batch.column("k2").to_numpy()
        lists = batch.column("hits")
        hits = lists.flatten()
        ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
        h, at = hits.field("h").to_numpy(), hits.field("at").to_numpy()
        kind = hits.field("hot").to_numpy(zero_copy_only=False)
        for lo, hi in textkit.row_slices(offsets):
            base = offsets[lo]
            part = data[base : offsets[hi]]
            symbols = symbols_of(part, offsets[lo : hi + 1] - base, spec.unit)
            raw = part.tobytes()
            a, b = (ends[lo - 1] if lo else 0), ends[hi - 1]
            row = np.repeat(np.arange(lo, hi), np.diff(np.concatenate([[a], ends[lo:hi]])))
            pick = np.flatnonzero(kind[a:b] == hot)
            if not len(pick):
                continue
            row, place = row[pick], at[a:b][pick]
            first = symbols.first[row - lo] + (place >> 16)
            windows = ((place >> 8) & 255) + 1
            if not hot:
                spans = [symbols.span(s, s + n + spec.window - 1) for s, n in zip(first.tolist(), windows.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h[a:b][pick]),
                        pa.array(k1[row]),
                        pa.array(k2[row]),
                        pa.array(place),
                        pa.array([raw[s:e] for s, e in spans], pa.binary()),
                    ],
                    ["h", "k1", "k2", "at", "ctx"],
                )
                continue
            for r, s, p, n in zip(row.tolist(), first.tolist(), (place >> 16).tolist(), windows.tolist()):
                digests = []
                for i in range(n):
                    x, y = symbols.span(s + i, s + i + spec.window)
                    text = raw[x:y] if spec.unit == "bytes" else b" ".join(raw[x:y].split())
                    digests.append(hashlib.blake2b(text, digest_size=16).digest())
                pairs = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_pydict(
                    {
                        "w1": pairs[:, 0].copy(),
                        "w2": pairs[:, 1].copy(),
                        "k1": np.full(n, k1[r]),
                        "k2": np.full(n, k2[r]),
                        "start": np.arange(p, p + n),
                    }
                )


def key_slabs(batches: Iterator[pa.RecordBatch], key: str, min_rows: int) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by an integer ``key``."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < min_rows:
            continue
        last = batch.column(key)[-1].as_py()
        table = pa.Table.from_batches(held)
        cut = int(np.searchsorted(table.column(key).to_numpy(), last))
        if cut:
            yield table.slice(0, cut)
            held = table.slice(cut).to_batches()
            rows -= cut
    if rows:
        yield pa.Table.from_batches(held)


def _solve(batches: Iterator[pa.RecordBatch], spec: RepeatSpec, solver: Solver) -> Iterator[pa.RecordBatch]:
    for slab in key_slabs(batches, "h", spec.slab_rows):
        start, stop = solver(slab, spec)
        hit = np.flatnonzero(stop > start)
        if not len(hit):
            continue
        origin = slab.column("at").to_numpy()[hit] >> 16
        yield pa.RecordBatch.from_pydict(
            {
                "k1": slab.column("k1").to_numpy()[hit],
                "k2": slab.column("k2").to_numpy()[hit],
                "start": origin + start[hit],
                "stop": origin + stop[hit],
            }
        )


def merge_spans(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open spans as maximal runs in order."""
    if not len(starts):
        return starts, stops
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(stops[order])
    head = np.ones(len(starts), bool)
    head[1:] = starts[1:] > reach[:-1]
    tail = np.append(np.flatnonzero(head)[1:], len(starts)) - 1
    return starts[head], reach[tail]


def _cut(batches: Iterator[pa.RecordBatch], spec: RepeatSpec, passed: list[str]) -> Iterator[pa.RecordBatch]:
    """Texts without their covered symbols, with the removed runs."""
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    for batch in batches:
        data, offsets = textkit.column_bytes(batch.column("text"))
        lists = batch.column("spans").to_pylist()
        copies = batch.column("copies").to_numpy()
        for lo, hi in textkit.row_slices(offsets):
            base = offsets[lo]
            part = data[base : offsets[hi]]
            symbols = symbols_of(part, offsets[lo : hi + 1] - base, spec.unit)
            raw = part.tobytes()
            kept, removed, totals, gone = [], [], [], []
            for r in range(lo, hi):
                a, b = int(symbols.first[r - lo]), int(symbols.first[r - lo + 1])
                n = b - a
                if copies[r] > 1 and n >= spec.window:
                    starts, stops = np.array([0]), np.array([n])
                elif lists[r]:
                    spans = np.array([(s["start"], s["stop"]) for s in lists[r]], np.int64)
                    starts, stops = merge_spans(spans[:, 0], spans[:, 1])
                else:
                    starts = stops = np.zeros(0, np.int64)
                # the kept stretches lie between the removed runs
                left = np.concatenate([[0], stops]) + a
                right = np.concatenate([starts, [n]]) + a
                pieces = [symbols.span(x, y) for x, y in zip(left.tolist(), right.tolist()) if y > x]
                if spec.unit == "bytes":
                    kept.append(b"".join(raw[x:y] for x, y in pieces))
                elif spec.keep_layout:
                    whole = raw[offsets[r] - base : offsets[r + 1] - base]
                    kept.append(b"\n".join(raw[x:y] for x, y in pieces) if len(starts) else whole)
                else:
                    kept.append(b" ".join(b" ".join(raw[x:y].split()) for x, y in pieces))
                totals.append(n)
                gone.append(int((stops - starts).sum()))
                removed.append([{"start": x, "stop": y} for x, y in zip(starts.tolist(), stops.tolist())])
            cut = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays(
                [cut.column(c) for c in passed]
                + [pa.array(kept, pa.binary()), pa.array(totals, pa.int64()), pa.array(gone, pa.int64()), pa.array(removed, span_type)],
                [*passed, "kept", "n_symbols", "n_removed", "removed"],
            )


_SPANS = "array<struct<start:bigint,stop:bigint>>"


def join_hot(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """``rows.join(keys, on)`` for keys that an aggregation has just made unique.

    ``keys`` is already partitioned by ``on``, so Spark would join it without a
    shuffle of its own, and adaptive execution could not split a hot key. Both
    sides are joined on the complement instead, which shuffles both.
    """
    flipped = keys.select(*[F.bitwise_not(c).alias(f"_{c}") for c in on], *[c for c in keys.columns if c not in on])
    same = [F.bitwise_not(rows[c]) == flipped[f"_{c}"] for c in on]
    return rows.join(flipped, same).drop(*[f"_{c}" for c in on])


@dataclass(frozen=True)
class RepeatFrames:
    """The steps of one removal, for reports beside the removal itself."""

    texts: DataFrame  # k1, k2, copies, text, doc: one row per distinct text
    runs: DataFrame  # h, k1, k2, at, ctx: runs whose minimiser occurs twice
    covered: DataFrame  # k1, k2, start, stop
    keyed: DataFrame  # k1, k2, doc: one row per input row


def repeat_frames(docs: DataFrame, text_col: str, spec: RepeatSpec, solver: Solver) -> RepeatFrames:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    others = [F.col(c) for c in docs.columns if c != text_col]
    keyed = docs.select(
        F.struct(*(others or [F.lit(None).alias("_none")])).alias("doc"),
        text.alias("text"),
        F.xxhash64(text).alias("k1"),
        F.xxhash64(F.lit(29), text).alias("k2"),
    )
    texts = keyed.groupBy("k1", "k2").agg(
        F.count(F.lit(1)).alias("copies"), F.first("text").alias("text"), F.first("doc").alias("doc")
    )
    # Every step takes all columns of ``texts``: with equal columns their plans
    # share the one shuffle of the texts.
    counts = (
        texts.mapInArrow(lambda it: _minimisers(it, spec, False), "h bigint")
        .groupBy("h")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )
    placed = texts.mapInArrow(lambda it: _minimisers(it, spec, True), "h bigint, k1 bigint, k2 bigint, at bigint")
    hits = (
        join_hot(placed, counts, ["h"])
        .groupBy("k1", "k2")
        .agg(F.collect_list(F.struct("h", "at", (F.col("n") > spec.hot_group).alias("hot"))).alias("hits"))
    )
    runs = texts.join(hits, ["k1", "k2"]).mapInArrow(
        lambda it: _contexts(it, spec, False), "h bigint, k1 bigint, k2 bigint, at bigint, ctx binary"
    )
    covered = (
        runs.repartition("h")
        .sortWithinPartitions("h")
        .mapInArrow(lambda it: _solve(it, spec, solver), "k1 bigint, k2 bigint, start bigint, stop bigint")
    )
    windows = texts.join(hits.filter(F.exists("hits", lambda x: x["hot"])), ["k1", "k2"]).mapInArrow(
        lambda it: _contexts(it, spec, True), "w1 bigint, w2 bigint, k1 bigint, k2 bigint, start bigint"
    )
    repeated = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    covered = covered.unionByName(
        join_hot(windows, repeated, ["w1", "w2"]).select(
            "k1", "k2", "start", (F.col("start") + F.lit(spec.window)).cast("bigint").alias("stop")
        )
    )
    return RepeatFrames(texts, runs, covered, keyed.drop("text"))


def remove_repeats(docs: DataFrame, text_col: str, spec: RepeatSpec, solver: Solver) -> DataFrame:
    """Every row of ``docs`` without its repeated passages.

    Returns the other columns of ``docs`` (as they were), ``kept`` (binary),
    ``n_symbols``, ``n_removed`` and ``removed`` (maximal removed runs in
    symbols). Exact copies of a text of at least one window are removed whole;
    a shorter or null text is kept as it is (null as empty). A row repeated in
    full counts as a copy.
    """
    frames = repeat_frames(docs, text_col, spec, solver)
    spans = frames.covered.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    result = f"kept binary, n_symbols bigint, n_removed bigint, removed {_SPANS}"
    doc_type = frames.texts.schema["doc"].dataType
    results = [T.StructField("kept", T.BinaryType())] + T.StructType.fromDDL(result).fields[1:]

    single = (
        frames.texts.filter("copies = 1")
        .join(spans, ["k1", "k2"], "left")
        .mapInArrow(lambda it: _cut(it, spec, ["doc"]), T.StructType([T.StructField("doc", doc_type), *results]))
    )
    # Copies need no spans: a window of a copied text always repeats.
    copied = (
        frames.texts.filter("copies > 1")
        .withColumn("spans", F.lit(None).cast(_SPANS))
        .mapInArrow(lambda it: _cut(it, spec, ["k1", "k2"]), f"k1 bigint, k2 bigint, {result}")
        .join(frames.keyed, ["k1", "k2"])
        .select("doc", "kept", "n_symbols", "n_removed", "removed")
    )
    both = single.unionByName(copied)
    clash = {"kept", "n_symbols", "n_removed", "removed"}
    names = [c for c in docs.columns if c != text_col]
    return both.select(
        *[F.col("doc").getField(c).alias(c) for c in names if c not in clash], "kept", "n_symbols", "n_removed", "removed"
    )
