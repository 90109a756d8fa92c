"""Substring dedup: repeated word passages by sharded phrase automata.

The runs that share a minimiser (see ``repeats``) hold every occurrence of
the windows they span. In each shard (whole groups, at most a few dozen runs
unless one group is larger):

1. the windows are counted word for word, which confirms those that recur;
   consecutive recurring windows of a run make one passage;
2. the distinct passages are compiled into one Aho-Corasick automaton over
   word numbers (pyahocorasick);
3. every run of the shard is streamed through the automaton, which reports
   every occurrence of every passage, whichever text it came from.

So every document passes the automata of exactly the shards whose minimisers
it contains, and the work grows with the input, not with documents x shards.
"""

from __future__ import annotations

from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.repeats import RepeatSpec, remove_repeats

WINDOW_WORDS = 35
GRAM_WORDS = 8
SHARD_RUNS = 64


def _passages(runs: list[np.ndarray], window: int) -> set[tuple[int, ...]]:
    """The confirmed passages of a shard."""
    width = window * 4
    seen: Counter[bytes] = Counter()
    rows = []
    for ids in runs:
        raw = ids.tobytes()
        keys = [raw[p : p + width] for p in range(0, len(raw) - width + 1, 4)]
        rows.append(keys)
        seen.update(keys)
    found: set[tuple[int, ...]] = set()
    for ids, keys in zip(runs, rows):
        flags = np.fromiter((seen[k] > 1 for k in keys), bool, len(keys))
        if not flags.any():
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
        for a, b in zip(edge[0::2].tolist(), edge[1::2].tolist()):
            found.add(tuple(ids[a : b + window - 1].tolist()))
    return found


def _shard(runs: list[np.ndarray], window: int) -> list[tuple[int, int]]:
    """Covered ``(start, stop)`` of each run, ``(0, 0)`` if none."""
    passages = _passages(runs, window)
    if not passages:
        return [(0, 0)] * len(runs)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for passage in passages:
        automaton.add_word(passage, len(passage))
    automaton.make_automaton()
    out = []
    for ids in runs:
        start, stop = len(ids), 0
        for end, length in automaton.iter(tuple(ids.tolist())):
            start, stop = min(start, end - length + 1), max(stop, end + 1)
        out.append((start, stop) if stop else (0, 0))
    return out


def covered_by_phrases(slab: pa.Table, spec: RepeatSpec) -> tuple[np.ndarray, np.ndarray]:
    """Per run the stretch of words covered by recurring passages. All of its
    windows contain the run's minimiser, so their union is one stretch."""
    h = slab.column("h").to_numpy()
    numbers: dict[bytes, int] = {}
    runs = []
    for ctx in slab.column("ctx").to_pylist():
        runs.append(np.array([numbers.setdefault(w, len(numbers)) for w in ctx.split()], np.int32))
    heads = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])).tolist() + [len(h)]
    out: list[tuple[int, int]] = []
    first = 0
    for head in heads[1:]:
        if head - first >= SHARD_RUNS or head == len(h):
            out += _shard(runs[first:head], spec.window)
            first = head
    spans = np.array(out, np.int64).reshape(-1, 2)
    return spans[:, 0], spans[:, 1]


def spec_for(
    window: int = WINDOW_WORDS, gram: int = GRAM_WORDS, hot_group: int = 1 << 16, keep_layout: bool = False
) -> RepeatSpec:
    return RepeatSpec("words", window, gram, hot_group, keep_layout=keep_layout)


def remove_repeated_passages(docs: DataFrame, text_col: str = "text", spec: RepeatSpec | None = None) -> DataFrame:
    """Cut every word covered by a recurring ``window``-word passage.

    Words are ``[^\\x20\\x09-\\x0D]+``. ``kept`` is the kept words joined by one
    space, ``removed`` the maximal removed word runs. Null text has no words;
    empty tables give empty results; texts of any length are handled whole;
    repeated rows and exact copies remove each other; other columns pass
    through, but for those named like a result column.
    """
    out = remove_repeats(docs, text_col, spec or spec_for(), covered_by_phrases)
    return out.withColumn("kept", F.col("kept").cast("string"))
