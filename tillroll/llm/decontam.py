"""Benchmark decontamination with one Aho-Corasick automaton.

Texts and benchmark items are normalised alike: A-Z lower-cased, every ASCII
character that is no letter or digit a separator, words joined by one space.
Every run of ``window`` consecutive item words is a pattern (an item of fewer
words is one pattern), closed by spaces so that only whole words match. All
patterns are compiled into one automaton, and each text is scanned once, in
pieces that overlap by the longest pattern, so memory does not grow with the
text. Matches are mapped back to the original text by word number.

The benchmark's windows are cut by Spark and go to the tasks in shards by their
hash, each of at most about ``max_pattern_bytes`` and with an automaton of its
own. Up to that size there is one shard and one scan. A larger benchmark takes
one scan a shard, each adding its hits to those of the scan before, so neither
the driver nor a task ever holds more than one shard.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm import textkit
from tillroll.session import materialize

WINDOW_WORDS = 10
# Of one automaton, which takes some 60 times this memory.
MAX_PATTERN_BYTES = 8 << 20
PIECE_CHARS = 1 << 20

_NORMAL = bytes(0x20 if textkit.NON_ALNUM[b] else int(b) for b in textkit.LOWER)


def normal_words(text: str | None) -> list[bytes]:
    """The words of a text; separators are ASCII only, so bytes split safely."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_NORMAL).split()


def _windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """``(pattern, item)`` of every window of the items."""
    for batch in batches:
        for name, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
            words = normal_words(text)
            keys = {b" ".join(words[at : at + window]) for at in range(max(len(words) - window + 1, 1) if words else 0)}
            if keys:
                patterns = pa.array([" " + k.decode("latin-1") + " " for k in sorted(keys)])
                yield pa.RecordBatch.from_arrays([patterns, pa.array([name] * len(keys), pa.string())], ["pattern", "item"])


def windows_of(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """``(pattern, item)``: every window once an item. Rows of one id are one
    item; a null id counts as the empty id; items without words have none."""
    items = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).cast("string").alias("text")
    )
    return items.mapInArrow(lambda it: _windows(it, window), "pattern string, item string").distinct()


def patterns_of(rows: list[tuple[str, str]]) -> tuple[list[str], list[list[int]], list[str]]:
    """``(patterns, items of each pattern, item ids)`` of ``(pattern, item)``."""
    ids = sorted({item for _, item in rows})
    number = {name: k for k, name in enumerate(ids)}
    found: dict[str, set[int]] = {}
    for pattern, item in rows:
        found.setdefault(pattern, set()).add(number[item])
    return list(found), [sorted(v) for v in found.values()], ids


def _automaton(patterns: list[str]) -> ahocorasick.Automaton:
    out = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for k, pattern in enumerate(patterns):
        out.add_word(pattern, k)
    out.make_automaton()
    return out


# The automaton last built in this process, under the key of its patterns: the
# tasks of a worker process share it.
_BUILT: dict[str, ahocorasick.Automaton | None] = {}


def _built(key: str, patterns: list[str]) -> ahocorasick.Automaton | None:
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = _automaton(patterns) if patterns else None
    return _BUILT[key]


def _matches(automaton: ahocorasick.Automaton, text: str, longest: int) -> Iterator[tuple[int, int]]:
    """``(end, pattern)`` of every match, each once, over pieces of the text."""
    if len(text) <= PIECE_CHARS:
        yield from automaton.iter(text)
        return
    for lo in range(0, len(text), PIECE_CHARS):
        back = min(lo, longest)
        for end, k in automaton.iter(text[lo - back : lo + PIECE_CHARS]):
            if end >= back:  # ends before belong to the piece before
                yield end + lo - back, k


def _spans(text: str, runs: list[tuple[int, int]]) -> list[dict]:
    """Runs of words as code point spans of the original text."""
    raw = text.encode("utf-8", "surrogatepass")
    data = textkit.LOWER[np.frombuffer(raw, np.uint8)]
    starts, ends, _ = textkit.word_spans(data, np.array([0, len(data)]), textkit.NON_ALNUM)
    out, chars, at = [], 0, 0
    for a, b in runs:
        x, y = int(starts[a]), int(ends[b - 1])
        chars += len(raw[at:x].decode("utf-8", "surrogatepass"))
        begin = chars
        chars += len(raw[x:y].decode("utf-8", "surrogatepass"))
        at = y
        out.append({"start": begin, "stop": chars})
    return out


def _scan(batches: Iterator[pa.RecordBatch], shared, again: bool) -> Iterator[pa.RecordBatch]:
    """The hits of one shard's patterns, with ``again`` beside those found by
    the scans before (``runs`` of words and ``items``)."""
    key, patterns, owners, ids = shared.value
    automaton = _built(key, patterns)
    sizes = [p.count(" ") - 1 for p in patterns]
    longest = max(map(len, patterns), default=0)
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    for batch in batches:
        n_words, n_hit, spans, items, runs = [], [], [], [], []
        earlier = zip(batch.column("runs").to_pylist(), batch.column("items").to_pylist()) if again else None
        for scalar in batch.column("text"):
            text = scalar.as_py()
            words = normal_words(text)
            n_words.append(len(words))
            # each word is closed by one space, so a place maps to a word number
            normal = " " + b" ".join(words).decode("latin-1") + " " if words else ""
            old_runs, old_items = next(earlier) if earlier else ((), ())
            marks, seen = [], set()
            for end, k in _matches(automaton, normal, longest) if automaton and words else ():
                marks.append((end, sizes[k]))
                seen.update(owners[k])
            if not marks and not old_runs:
                n_hit.append(0)
                for column in (spans, items, runs):
                    column.append([])
                continue
            flags = np.zeros(len(words) + 1, np.int64)
            if marks:
                blanks = np.flatnonzero(np.frombuffer(normal.encode("latin-1"), np.uint8) == 0x20)
                stop = np.searchsorted(blanks, np.array([m[0] for m in marks]))  # words before the closing space
                np.add.at(flags, stop - np.array([m[1] for m in marks]), 1)
                np.add.at(flags, stop, -1)
            for run in old_runs:
                flags[run["start"]] += 1
                flags[run["stop"]] -= 1
            hit = np.cumsum(flags[:-1]) > 0
            edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))).tolist()
            own = list(zip(edge[0::2], edge[1::2]))
            n_hit.append(int(hit.sum()))
            spans.append(_spans(text, own))
            items.append(sorted({ids[k] for k in seen}.union(old_items)))
            runs.append([{"start": a, "stop": b} for a, b in own])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(spans, span_type),
             pa.array(items, pa.list_(pa.string())), pa.array(runs, span_type)],
            ["doc", "n_words", "n_hit", "spans", "items", "runs"],
        )


_SPANS = "array<struct<start:bigint,stop:bigint>>"


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW_WORDS,
    max_pattern_bytes: int = MAX_PATTERN_BYTES,
) -> DataFrame:
    """Every row of ``docs`` with its contamination.

    Adds ``n_words``, ``n_hit`` (words inside an occurring window), ``spans``
    (code point spans of the hit runs in the original text) and ``items`` (ids
    of the items found, as sorted strings), replacing columns of these names.
    Null and empty texts have no words. Repeated rows are scanned alike, and
    empty tables are allowed.
    """
    spark = docs.sparkSession
    size = benchmark.agg(F.sum(F.length(F.col(item_text_col).cast("binary")))).first()[0] or 0
    shards = max(-(-size * window // max_pattern_bytes), 1)
    windows = windows_of(benchmark, item_col, item_text_col, window)
    if shards > 1:
        windows = materialize(windows, "leak-windows")
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col(text_col).cast("string").alias("text"))
    result = T.StructType.fromDDL(f"n_words bigint, n_hit bigint, spans {_SPANS}, items array<string>, runs {_SPANS}")
    kind = T.StructType([rows.schema["doc"], *result.fields])
    for k in range(shards):
        part = windows.filter(F.pmod(F.xxhash64("pattern"), F.lit(shards)) == k).collect()
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, *patterns_of([tuple(r) for r in part])))
        rows = rows.mapInArrow(lambda it, shared=shared, again=k > 0: _scan(it, shared, again), kind)
        if k < shards - 1:
            rows = materialize(rows, "leak-scan").select("doc", F.col("doc").getField(text_col).cast("string").alias("text"), "runs", "items")
            shared.destroy()
    names = [c for c in docs.columns if c not in result.names[:4]]
    return rows.select(*[F.col("doc").getField(c).alias(c) for c in names], *result.names[:4])


def drop_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows without any benchmark window, with the columns of ``docs``."""
    names = docs.columns
    marked = find_leaks(docs.select(F.struct(*names).alias("_row"), F.col(options.pop("text_col", "text")).alias("text")), benchmark, **options)
    return marked.filter("n_hit = 0").select(*[F.col("_row").getField(c).alias(c) for c in names])
