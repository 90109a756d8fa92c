"""Secret scans: fixed patterns, and Markov models of how secrets are spelled.

Two chains of characters are learnt, one of random strings and one of ordinary
identifiers. Samples are labelled by the patterns: what a pattern caught is a
random string, every other long token is an ordinary one; the chains are then
learnt once more without the tokens that look more like random strings, since
no pattern labels those. (Labelled samples of a caller's own do as well, see
``sample_counts``.) A token that no pattern touches is reported when the
logarithm of its likelihood ratio exceeds the logarithm of the odds of an
ordinary token.

Transitions are counted over all documents: a task adds its texts up in one
table of the alphabet's size, and only these tables are shuffled and reach the
driver. Log ratios are kept as integers of 2**-20, so that a token's score
does not depend on its neighbours. Texts are handled as bytes; every pattern
is made of ASCII, so byte matches are character matches.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm import textkit

# The patterns, with the least length of a match that counts
# (of the value, for an assignment).
ASSIGN = re.compile(rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_HEADS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "random")

ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
_SIZE = len(ALPHABET) + 1  # one more: the start of a token, or any other character
_START = len(ALPHABET)
_CODE = np.full(256, _START, np.uint8)
_CODE[list(ALPHABET)] = np.arange(len(ALPHABET))
_WORD = _CODE != _START
_WORD[0x80:] = True  # a token ends at ASCII characters only
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True
_TOKENS = 2 * _SIZE * _SIZE  # the two slots after the transitions: tokens of each class
_UNIT = 1 << 20

PRIOR = 16  # transitions that the frequency of single characters stands for
RELEARN = 1  # rounds without the unlabelled tokens that look like random strings
LEAST_TOKEN = 16  # characters of a token that is judged by its spelling


@dataclass(frozen=True)
class SecretModel:
    """``ratio[before, character]`` in units of 2**-20, and the score that a
    token must exceed."""

    ratio: np.ndarray
    threshold: float

    def score(self, token: str) -> float:
        codes = _CODE[np.frombuffer(token.encode(), np.uint8)]
        return int(self.ratio[np.concatenate([[_START], codes[:-1]]), codes].sum()) / _UNIT if len(codes) else 0.0


def _long_runs(inside: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """``(starts, ends)`` of the runs of at least ``least`` true values."""
    edge = np.empty(len(inside) + 1, bool)
    edge[0], edge[-1] = inside[0], inside[-1]
    np.not_equal(inside[1:], inside[:-1], out=edge[1:-1])
    marks = np.flatnonzero(edge)
    starts, ends = marks[0::2], marks[1::2]
    long = ends - starts >= least
    return starts[long], ends[long]


def _places(raw: bytes, head: bytes) -> Iterator[int]:
    at = raw.find(head)
    while at >= 0:
        yield at
        at = raw.find(head, at + 1)


def _matches(raw: bytes, pattern: re.Pattern, places: list[int]) -> Iterator[re.Match]:
    """Leftmost matches that do not overlap, given where one can begin."""
    end = 0
    for at in places:
        if at >= end and (found := pattern.match(raw, at)):
            yield found
            end = found.end()


def base_spans(raw: bytes) -> list[tuple[int, int, int, int]]:
    """``(start, kind, end, start of the value)`` of every match of the fixed
    patterns, in order."""
    if not raw:
        return []
    lowered = raw.lower()
    heads = sorted(at for head in ASSIGN_HEADS for at in _places(lowered, head))
    spans = [(m.start(), 0, m.end(), m.start(1)) for m in _matches(raw, ASSIGN, heads) if m.end() - m.start(1) >= LEAST_ASSIGN]
    keys = list(_places(raw, b"AKIA"))
    spans += [(m.start(), 1, m.end(), m.start() + 4) for m in _matches(raw, ACCESS, keys) if m.end() - m.start() >= LEAST_ACCESS]
    starts, ends = _long_runs(_HEX[np.frombuffer(raw, np.uint8)], LEAST_HEX)
    spans += [(s, 2, e, s) for s, e in zip(starts.tolist(), ends.tolist())]
    return sorted(spans)


def _tokens(data: np.ndarray, spans: list[tuple[int, int, int, int]], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the long ASCII tokens that no base span touches."""
    starts, ends = _long_runs(_WORD[data], least)
    if not len(starts):
        return starts, ends
    other = np.concatenate([[0], np.cumsum(data >= 0x80)])
    free = other[ends] == other[starts]
    for s, _, e, _ in spans:
        free[np.searchsorted(ends, s, side="right") : np.searchsorted(starts, e, side="left")] = False
    return starts[free], ends[free]


def _steps(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(before, character, first)`` of the tokens, some at a time; ``first``
    has the place of each token's first character."""
    sizes = ends - starts
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    for lo, hi in textkit.row_slices(bounds):
        first = bounds[lo:hi] - bounds[lo]
        at = np.arange(bounds[hi] - bounds[lo]) + np.repeat(starts[lo:hi] - first, sizes[lo:hi])
        codes = _CODE[data[at]]
        before = np.concatenate([[_START], codes[:-1]])
        before[first] = _START
        yield before.astype(np.int64), codes.astype(np.int64), first


def _joined(column: pa.Array) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """``(first row, end row, bytes, row starts)``: slices of texts with a line
    end, which no pattern crosses, between rows."""
    data, offsets = textkit.column_bytes(column)
    for lo, hi in textkit.row_slices(offsets):
        base, edges = offsets[lo], offsets[lo : hi + 1]
        part = data[base : edges[-1]].tobytes()
        places = (edges - base).tolist()
        yield lo, hi, b"\n".join([part[a:b] for a, b in zip(places, places[1:])]), (edges[:-1] - base) + np.arange(hi - lo)


def _counted(total: np.ndarray) -> pa.RecordBatch:
    slots = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int64)), pa.array(total[slots])], ["slot", "n"])


def _add(total: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, secret: bool) -> None:
    for before, codes, _ in _steps(data, starts, ends):
        slots = (int(secret) * _SIZE + before) * _SIZE + codes
        total[: _TOKENS] += np.bincount(slots, minlength=_TOKENS)
    total[_TOKENS + int(secret)] += len(starts)


def _scores(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, model: SecretModel) -> np.ndarray:
    scores = [np.add.reduceat(model.ratio[before, codes], first) for before, codes, first in _steps(data, starts, ends)]
    return np.concatenate([np.zeros(0, np.int64), *scores]) / _UNIT


def _count(batches: Iterator[pa.RecordBatch], least: int, model: SecretModel | None) -> Iterator[pa.RecordBatch]:
    total = np.zeros(_TOKENS + 2, np.int64)
    for batch in batches:
        for _, _, raw, _ in _joined(batch.column("text")):
            if not raw:
                continue
            data = np.frombuffer(raw, np.uint8)
            spans = base_spans(raw)
            starts, ends = _tokens(data, spans, least)
            if model is not None:
                usual = _scores(data, starts, ends, model) <= 0
                starts, ends = starts[usual], ends[usual]
            _add(total, data, starts, ends, False)
            if spans:
                value = np.zeros(len(data), bool)
                for _, _, end, start in spans:
                    value[start:end] = True
                _add(total, data, *_long_runs(value & (_CODE[data] != _START), LEAST_ASSIGN), True)
    yield _counted(total)


def _count_samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(_TOKENS + 2, np.int64)
    for batch in batches:
        secret = batch.column("secret").to_numpy(zero_copy_only=False).astype(bool)
        data, offsets = textkit.column_bytes(batch.column("text"))
        for kind in (False, True):
            pick = np.flatnonzero((secret == kind) & (np.diff(offsets) > 0))
            _add(total, data, offsets[pick], offsets[pick + 1], kind)
    yield _counted(total)


def _summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy("slot").agg(F.sum("n").alias("n"))


def corpus_counts(docs: DataFrame, text_col: str = "text", least: int = LEAST_TOKEN, model: SecretModel | None = None) -> DataFrame:
    """Transitions of both classes over all documents (``slot``, ``n``); the
    tokens that ``model`` finds likelier to be random strings are left out."""
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    return _summed(texts.mapInArrow(lambda it: _count(it, least, model), "slot bigint, n bigint"))


def sample_counts(samples: DataFrame, value_col: str, secret_col: str) -> DataFrame:
    """The same counts from labelled strings; rows without a label or text are
    left out."""
    rows = samples.select(F.col(value_col).cast("string").alias("text"), F.col(secret_col).cast("boolean").alias("secret"))
    return _summed(rows.dropna().mapInArrow(_count_samples, "slot bigint, n bigint"))


def fit(counts: DataFrame, threshold: float | None = None) -> SecretModel:
    """The model of some counts. A transition falls back on how frequent its
    character is, as if ``PRIOR`` more had been seen, and characters are
    smoothed by one half. Without ``threshold`` it is the logarithm of ordinary
    tokens per secret. Without any samples every score is zero and nothing is
    reported."""
    total = np.zeros(_TOKENS + 2, np.int64)
    for slot, n in counts.collect():  # two tables of the alphabet's size at most
        total[slot] = n
    chains = total[:_TOKENS].reshape(2, _SIZE, _SIZE)[:, :, : len(ALPHABET)]
    single = chains.sum(axis=1, keepdims=True) + 0.5
    single /= single.sum(axis=2, keepdims=True)
    logs = np.log((chains + PRIOR * single) / (chains.sum(axis=2, keepdims=True) + PRIOR))
    ratio = np.zeros((_SIZE, _SIZE), np.int64)
    ratio[:, : len(ALPHABET)] = np.rint((logs[1] - logs[0]) * _UNIT)
    if threshold is None:
        threshold = math.log((total[_TOKENS] + 1) / (total[_TOKENS + 1] + 1))
    return SecretModel(ratio, threshold)


def train(docs: DataFrame, text_col: str = "text", threshold: float | None = None) -> SecretModel:
    """A model of all documents, labelled by the fixed patterns."""
    model = fit(corpus_counts(docs, text_col))
    for _ in range(RELEARN):
        model = fit(corpus_counts(docs, text_col, model=model), threshold)
    return model


def _found(raw: bytes, model: SecretModel, least: int) -> list[tuple[int, int, int, float | None]]:
    """``(start, kind, end, score)`` of all spans of a slice, in order."""
    data, base = np.frombuffer(raw, np.uint8), base_spans(raw)
    spans = [(s, k, e, None) for s, k, e, _ in base]
    if len(data):
        starts, ends = _tokens(data, base, least)
        score = _scores(data, starts, ends, model)
        hit = np.flatnonzero(score > model.threshold)
        spans += [(int(starts[i]), 3, int(ends[i]), float(score[i])) for i in hit]
    return sorted(spans, key=lambda x: x[:3])


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("score", pa.float64())])


def _scan(batches: Iterator[pa.RecordBatch], model: SecretModel, least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, raw, row_starts in _joined(batch.column("text")):
            rows: list[list] = [[] for _ in range(hi - lo)]
            spans = _found(raw, model, least)
            owner = np.searchsorted(row_starts, [s for s, *_ in spans], side="right") - 1
            for (start, kind, end, score), r in zip(spans, owner.tolist()):
                first = int(row_starts[r])
                a = len(raw[first:start].decode("utf-8", "replace"))  # characters before
                rows[r].append({"kind": KINDS[kind], "start": a, "stop": a + end - start, "score": score})
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").slice(lo, hi - lo), pa.array(rows, pa.list_(_SPAN))], ["doc", "secrets"]
            )


def scan_secrets(
    docs: DataFrame, model: SecretModel, text_col: str = "text", out_col: str = "secrets", least: int = LEAST_TOKEN
) -> DataFrame:
    """Every row's other columns and ``out_col``: its spans (``kind``,
    ``start``, ``stop`` in characters, end exclusive, ``score`` of a random
    one) by start, then kind.

    Kinds ``assign``, ``access`` and ``hex`` are the matches of the fixed
    patterns, each kind leftmost first and without overlaps in itself. Kind
    ``random`` is a token of at least ``least`` characters that the model takes
    for a random string and that no other span touches. Null and empty texts
    have none; repeated rows stay. An input column named ``out_col`` gives way.
    """
    names = [c for c in docs.columns if c not in (text_col, out_col)]
    doc = F.struct(*([F.col(c) for c in names] or [F.lit(None).alias("_none")])).alias("doc")
    rows = docs.select(doc, F.col(text_col).cast("string").alias("text"))
    kind = T.StructType.fromDDL("secrets array<struct<kind:string,start:bigint,stop:bigint,score:double>>").fields
    out = T.StructType([rows.schema["doc"], *kind])
    found = rows.mapInArrow(lambda it: _scan(it, model, least), out)
    return found.select(*[F.col("doc").getField(c).alias(c) for c in names], F.col("secrets").alias(out_col))
