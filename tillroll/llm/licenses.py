"""License scans by conditional compression.

Candidate blocks come from the templates themselves. A stretch that can be
accepted differs from its template in few words, so it holds one of that
template's key words (its longest words, one more than may differ), and as many
of its words as may not differ, close together. Texts without a key word never
leave the JVM's filter; in the others each place where enough words of a
template stand close together, with as many words on both sides as the longest
accepted stretch has, is a block (line breaks and marks of comments are white
space). Blocks are compressed alone and with each template they may hold as a
zstandard raw-content dictionary. The saving against
the plain size only ranks the templates (beside prose it is small for a
word-for-word statement too); the best ones are then accepted or rejected by
exact comparison of words: the differing words between the template and the
best matching stretches of the block, as inserted, deleted and replaced words.
Every confirmed stretch is given out; of overlapping ones the one with the
smallest share of differing words stays.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Statements that name the licenses, the whole MIT text, the grants of ISC and Unlicense.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies."""
_UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under the Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under the Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("All-rights-reserved", "Copyright. All rights reserved."),
    ("MIT", _MIT),
    ("ISC", _ISC),
    ("Unlicense", _UNLICENSE),
)
MAX_DIFFERENCE = 0.25
BLOCK_REACHES = 8  # a longer row of template words is more than one block
_WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")


def _words(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


@lru_cache(maxsize=4)
def _compressors(templates: tuple[tuple[str, str], ...]):
    import zstandard

    plain = zstandard.ZstdCompressor(level=19)
    with_template = [
        zstandard.ZstdCompressor(
            level=19, dict_data=zstandard.ZstdCompressionDict(t.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        )
        for _, t in templates
    ]
    return plain, with_template


def savings(block: str, templates: tuple[tuple[str, str], ...], some: Sequence[int]) -> dict[int, float]:
    """Share of the block's compressed size that each of ``some`` templates saves."""
    plain, with_template = _compressors(templates)
    raw = block.encode("utf-8", "surrogatepass")
    alone = len(plain.compress(raw))
    return {k: 1 - len(with_template[k].compress(raw)) / alone for k in some}


@lru_cache(maxsize=4)
def _coded(templates: tuple[tuple[str, str], ...]) -> tuple[dict[str, int], list[np.ndarray]]:
    """Numbers of all template words (from 1), and each template in them."""
    numbers: dict[str, int] = {}
    coded = [np.array([numbers.setdefault(w, len(numbers) + 1) for w in _words(t)], np.int64) for _, t in templates]
    return numbers, coded


def key_words(templates: Sequence[tuple[str, str]]) -> list[str]:
    """Words of which every acceptable stretch of any template holds one.

    A template of n words may lack int(MAX_DIFFERENCE * n) of them, so any words
    that make up one more of its places will do. Long words come first, as
    they are the rarer ones in most texts.
    """
    found: set[str] = set()
    for _, text in templates:
        words = _words(text)
        places, spare = Counter(words), int(MAX_DIFFERENCE * len(words))
        for word in sorted(places, key=lambda w: (-len(w), w)):
            if spare < 0:
                break
            found.add(word)
            spare -= places[word]
    return sorted(found)


def _key_pattern(templates: Sequence[tuple[str, str]]) -> str | None:
    """A Java pattern for the beginning of a key word; words are no case apart."""
    keys = key_words(templates)
    return r"(?iu)(?<![\p{L}\p{N}])(?:" + "|".join(rf"\Q{k}\E" for k in keys) + ")" if keys else None


def crowded(have: np.ndarray, coded: list[np.ndarray]) -> np.ndarray:
    """The places of template words in stretches long enough for a template,
    with one difference allowed for each word more, and full enough of its words."""
    out = np.zeros(len(have), bool)
    for want in coded:
        n = len(want)
        limit = int(MAX_DIFFERENCE * n)
        if not n:
            continue
        member = np.isin(have, want)
        total = np.concatenate([[0], np.cumsum(member)])
        stop = np.minimum(np.arange(len(have)) + n + limit, len(have))
        first = np.flatnonzero(total[stop] - total[:-1] >= n - limit)
        edge = np.zeros(len(have) + 1, np.int64)
        np.add.at(edge, first, 1)
        np.add.at(edge, stop[first], -1)
        out |= member & (np.cumsum(edge[:-1]) > 0)
    return np.flatnonzero(out)


def possible(have: np.ndarray, coded: list[np.ndarray]) -> list[int]:
    """The templates of which a block holds enough words."""
    return [k for k, want in enumerate(coded) if len(want) and int(np.isin(want, have).sum()) >= len(want) - int(MAX_DIFFERENCE * len(want))]


def differences(want: np.ndarray, have: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every end in ``have`` the fewest differing words of a stretch that
    ends there, and that stretch's start (the latest of equal ones)."""
    step = len(have) + 1
    ramp = np.arange(step) * step
    # differing words * step - start: one minimum compares both
    cost = -np.arange(step)
    for word in want.tolist():
        row = cost + step
        np.minimum(row[1:], cost[:-1] + np.where(have == word, 0, step), out=row[1:])
        cost = np.minimum.accumulate(row - ramp) + ramp
    differ = -(-cost // step)
    return differ, differ * step - cost


def stretches(have: np.ndarray, lo: int, hi: int, coded: list[np.ndarray], order: list[int]) -> list[tuple[int, int, int, int]]:
    """``(start, stop, template, differing words)`` of all confirmed stretches
    in ``have[lo:hi]``, without overlaps."""
    found = []
    for rank, k in enumerate(order):
        n = len(coded[k])
        limit = int(MAX_DIFFERENCE * n)
        if not n or int(np.isin(coded[k], have[lo:hi]).sum()) < n - limit:
            continue  # each absent word is a difference
        differ, start = differences(coded[k], have[lo:hi])
        for stop in np.flatnonzero(differ <= limit).tolist():
            a, d = int(start[stop]), int(differ[stop])
            found.append((d / n, -n, rank, abs(stop - a - n), lo + a, lo + stop, k, d))
    taken: list[tuple[int, int, int, int]] = []
    for *_, a, b, k, d in sorted(found):
        at = bisect_right(taken, (a, b, k, d))
        if (at == 0 or taken[at - 1][1] <= a) and (at == len(taken) or b <= taken[at][0]):
            taken.insert(at, (a, b, k, d))
    if not taken or len(taken) == len(found):
        return taken
    # a stretch that overlapped may have a shorter form beside those taken
    edges = [lo, *[e for a, b, _, _ in taken for e in (a, b)], hi]
    return sorted(taken + [x for a, b in zip(edges[::2], edges[1::2]) if b > a for x in stretches(have, a, b, coded, order)])


def blocks(hints: Sequence[int], reach: int, n_words: int) -> Iterator[tuple[int, int, int]]:
    """``(lo, hi, last)``: word ranges around template words (by word number),
    of ``reach`` words before the first and after the last one. Hints with
    common words share a block. In a long row of hints a block ends early: the
    stretches that start after its word ``last`` are left to the next block,
    but those that overlap earlier ones are in sight."""
    i, begin = 0, 0
    while i < len(hints):
        lo = max(hints[i] - reach, begin)
        while i + 1 < len(hints) and hints[i + 1] - hints[i] <= 2 * reach and hints[i + 1] - lo <= BLOCK_REACHES * reach:
            i += 1
        goes_on = i + 1 < len(hints) and hints[i + 1] - hints[i] <= 2 * reach
        hi = min(hints[i] + (2 if goes_on else 1) * reach + 1, n_words)
        last = hints[i] if goes_on else hi
        yield lo, hi, last
        begin = last + 1 if goes_on else hi
        i += 1


def scan_text(text: str, templates: tuple[tuple[str, str], ...]) -> list[dict]:
    numbers, coded = _coded(templates)
    reach = int((1 + MAX_DIFFERENCE) * max(map(len, coded), default=0))
    words = [(m.start(), m.end(), numbers.get(m.group().lower(), 0)) for m in _WORD.finditer(text)]
    if not words:
        return []
    starts, ends, have = np.array(words, np.int64).T
    at = crowded(have, coded).tolist()
    out: list[dict] = []
    done = 0
    for lo, hi, last in blocks(at, reach, len(have)):
        lo = max(lo, done)
        if lo >= hi:
            continue
        some = possible(have[lo:hi], coded)
        if not some:
            continue
        saving = savings(text[starts[lo] : ends[hi - 1]], templates, some)
        order = sorted(some, key=lambda k: (-saving[k], k))
        for a, b, k, differ in stretches(have, lo, hi, coded, order):
            if a > last:
                break
            out.append(
                {
                    "license": templates[k][0],
                    "start": int(starts[a]),
                    "stop": int(ends[b - 1]),
                    "saving": saving[k],
                    "differing_words": differ,
                }
            )
            done = b
    return out


_FOUND = "array<struct<license:string,start:bigint,stop:bigint,saving:double,differing_words:bigint>>"


def _scan(batches: Iterator[pa.RecordBatch], templates: tuple[tuple[str, str], ...]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(
        pa.struct([("license", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("saving", pa.float64()), ("differing_words", pa.int64())])
    )
    for batch in batches:
        found = [scan_text(t.as_py() or "", templates) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(found, kind)], ["doc", "licenses"])


def scan_licenses(docs: DataFrame, text_col: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """``docs`` with ``licenses``: the stretches found, in text order.

    Texts without a key word (null and empty ones among them) get an empty list
    without leaving the JVM's filter; whole texts are searched. Templates
    without words are never found. Repeated
    rows are scanned alike, a column named ``licenses`` is replaced, and an
    empty table gives no rows.
    """
    names = [c for c in docs.columns if c != "licenses"]
    fixed = tuple(tuple(t) for t in templates)
    keys = _key_pattern(fixed)
    hinted = F.coalesce(F.col(text_col).cast("string").rlike(keys), F.lit(False)) if keys else F.lit(False)
    rows = docs.select(
        F.struct(*docs.columns).alias("doc"), F.when(hinted, F.col(text_col).cast("string")).otherwise(F.lit("")).alias("text")
    )
    out = rows.mapInArrow(
        lambda it: _scan(it, fixed), T.StructType([rows.schema["doc"], *T.StructType.fromDDL(f"licenses {_FOUND}").fields])
    )
    return out.select(*[F.col("doc").getField(c).alias(c) for c in names], "licenses")
