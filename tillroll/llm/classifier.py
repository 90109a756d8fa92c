"""Quality classifier: a byte-level convolutional network in numpy.

A text's bytes are embedded by a table and passed through learned filters of
8 bytes at a step of 4, over overlapping chunks of 512 bytes (step 256) that
cover the whole text. Beside the byte values the filters see one more channel:
whether the 24 bytes from here on occur more than once in the text. Each chunk keeps every
filter's maximum; the mean and the maximum over all chunks are combined into
one probability by a logistic layer.

Training is stochastic gradient descent (Adam) with plain numpy on a bounded
sample of labelled texts on the driver (``SAMPLE_ROWS`` rows of at most
``SAMPLE_BYTES`` bytes each, by hash order, whole texts). The fitted arrays are
a few dozen KB and are sent to the tasks, which score every text in one pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm import textkit

SAMPLE_ROWS = 1500
SAMPLE_BYTES = 12_000
HALF, STEP, WIDTH = 256, 4, 8
REPEAT_BYTES = 24
PAD = 256
EMBED, FILTERS = 8, 16


@dataclass
class Net:
    embed: np.ndarray  # (257, EMBED)
    filters: np.ndarray  # (WIDTH, EMBED, FILTERS)
    repeat: np.ndarray  # (WIDTH, FILTERS)
    bias: np.ndarray  # (FILTERS,)
    out: np.ndarray  # (2 * FILTERS,)
    base: np.ndarray  # (1,)

    def arrays(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.repeat, self.bias, self.out, self.base]


def _fresh(seed: int) -> Net:
    rng = np.random.default_rng(seed)
    draw = lambda *s: rng.normal(0, 0.3, s).astype(np.float32)
    return Net(draw(257, EMBED), draw(WIDTH, EMBED, FILTERS), draw(WIDTH, FILTERS), np.zeros(FILTERS, np.float32), draw(2 * FILTERS) * 0.3, np.zeros(1, np.float32))


def layout(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(symbols, repeated, halves)``: rows padded to whole half chunks, a
    flag per byte, and the first half chunk of each row (one entry more)."""
    lengths = np.diff(offsets)
    halves = np.concatenate([[0], np.cumsum((lengths + WIDTH + HALF - 1) // HALF)])
    symbols = np.full(halves[-1] * HALF + WIDTH, PAD, np.int16)
    repeated = np.zeros(len(symbols), np.float32)
    place = np.arange(len(data)) + np.repeat(halves[:-1] * HALF - offsets[:-1], lengths)
    symbols[place] = data
    grams = textkit.gram_hashes(data, REPEAT_BYTES)
    for r in np.flatnonzero(lengths > REPEAT_BYTES).tolist():
        own = grams[offsets[r] : offsets[r + 1] - REPEAT_BYTES + 1]
        order = np.argsort(own)
        same = own[order[1:]] == own[order[:-1]]
        hit = np.concatenate([order[1:][same], order[:-1][same]])
        repeated[halves[r] * HALF + hit] = 1
    return symbols, repeated, halves


def _activations(net: Net, symbols: np.ndarray, repeated: np.ndarray, halves: np.ndarray) -> np.ndarray:
    """ReLU of the filters at every step, as (half chunks, steps, filters)."""
    n = halves[-1] * HALF
    z = np.tile(net.bias, (n // STEP, 1))
    for p in range(WIDTH):
        z += (net.embed @ net.filters[p])[symbols[p : n + p : STEP]]
        z += repeated[p : n + p : STEP, None] * net.repeat[p]
    z = np.maximum(z, 0).reshape(-1, HALF // STEP, FILTERS)
    z[halves[1:] - 1, -1] = 0  # the last step of a row would read the next row
    return z


def _pool(z: np.ndarray, halves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(chunk maxima, place of each maximum)``; chunk i is half i and, within
    the row, half i + 1."""
    top, at = z.max(axis=1), z.argmax(axis=1) + np.arange(len(z))[:, None] * z.shape[1]
    follow = np.ones(len(z), bool)
    follow[halves[1:] - 1] = False
    best, place = top.copy(), at.copy()
    better = np.zeros(top.shape, bool)
    better[:-1] = follow[:-1, None] & (top[1:] > top[:-1])
    rows, cols = np.nonzero(better)
    best[rows, cols], place[rows, cols] = top[rows + 1, cols], at[rows + 1, cols]
    return best, place


def _probability(net: Net, pooled: np.ndarray, halves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    counts = np.diff(halves)[:, None]
    features = np.hstack([np.add.reduceat(pooled, halves[:-1]) / counts, np.maximum.reduceat(pooled, halves[:-1])])
    return 1 / (1 + np.exp(-np.clip(features @ net.out + net.base, -30, 30))), features


def score_rows(net: Net, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    symbols, repeated, halves = layout(data, offsets)
    pooled, _ = _pool(_activations(net, symbols, repeated, halves), halves)
    return _probability(net, pooled, halves)[0]


def _gradients(net: Net, parts, labels: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
    symbols, repeated, halves = parts
    pooled, place = _pool(_activations(net, symbols, repeated, halves), halves)
    p, features = _probability(net, pooled, halves)
    d = ((p - labels) * weights / weights.sum()).astype(np.float32)
    counts = np.diff(halves)
    row = np.repeat(np.arange(len(counts)), counts)
    d_mean, d_max = np.outer(d, net.out[:FILTERS]), np.outer(d, net.out[FILTERS:])
    is_top = pooled == features[row, FILTERS:]
    ties = np.add.reduceat(is_top.astype(np.float32), halves[:-1])
    d_pool = d_mean[row] / counts[row, None] + is_top * d_max[row] / ties[row]
    d_pool *= pooled > 0
    chunk, f = np.nonzero(d_pool)
    g, at = d_pool[chunk, f].astype(np.float32), place[chunk, f] * STEP
    d_embed, d_filters, d_repeat = np.zeros_like(net.embed), np.zeros_like(net.filters), np.zeros_like(net.repeat)
    for k in range(WIDTH):
        flat = np.bincount(symbols[at + k].astype(np.int64) * FILTERS + f, g, 257 * FILTERS).reshape(257, FILTERS).astype(np.float32)
        d_embed += flat @ net.filters[k].T
        d_filters[k] = net.embed.T @ flat
        d_repeat[k] = np.bincount(f, g * repeated[at + k], FILTERS)
    return [d_embed, d_filters, d_repeat, np.bincount(f, g, FILTERS).astype(np.float32), (d @ features).astype(np.float32), np.array([d.sum()], np.float32)]


def fit(texts: list[bytes], labels: list[int], epochs: int = 10, batch: int = 48, rate: float = 0.01, seed: int = 5) -> Net:
    """Fit on whole texts; both classes weigh the same. Without texts of both
    classes the net is left at chance."""
    net = _fresh(seed)
    y = np.array(labels, np.float32)
    if not 0 < y.sum() < len(y):
        net.out[:] = 0
        return net
    share = y.mean()
    weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    rng = np.random.default_rng(seed)
    moments = [(np.zeros_like(a), np.zeros_like(a)) for a in net.arrays()]
    turn = 0
    batches = [np.arange(len(y))[i::max(1, len(y) // batch)] for i in range(max(1, len(y) // batch))]
    prepared = []
    for rows in batches:
        joined = np.frombuffer(b"".join(texts[i] for i in rows), np.uint8)
        prepared.append((layout(joined, np.concatenate([[0], np.cumsum([len(texts[i]) for i in rows])])), rows))
    total = epochs * len(prepared)
    for _ in range(epochs):
        for k in rng.permutation(len(prepared)):
            parts, rows = prepared[k]
            turn += 1
            speed = rate * (1 - 0.9 * turn / total)
            for a, g, (m, v) in zip(net.arrays(), _gradients(net, parts, y[rows], weight[rows]), moments):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                a -= speed * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
    return net


def held_out(doc_id: Column) -> Column:
    """Rows that training never sees: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES) -> Net:
    """Fit on at most ``sample_rows`` labelled documents that are not held out and
    have at most ``sample_bytes`` bytes, the first in hash order of their ids.

    They are chosen among the first ``4 * sample_rows`` labelled ids in that
    order, found by a cut on the hash, so that the texts moved do not grow with
    the input. An id with several labels or texts counts once, with the
    smallest. Null ids and labels are not used.
    """
    place = F.shiftrightunsigned(F.xxhash64(id_col), 11)  # 53 bits
    usable = F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col))
    wanted = labels.filter(usable).groupBy(id_col).agg(F.min(label_col).alias("_y"))
    # twice the ids needed pass the cut on average; the limit bounds the broadcast
    first = 4 * sample_rows
    cut = min(1.0, 2 * first / max(1, wanted.count()))
    chosen = wanted.filter(place < int(cut * 2**53)).orderBy(place, id_col).limit(first)
    rows = (
        docs.select(id_col, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
        .filter(F.octet_length("_text") <= sample_bytes)
        .join(F.broadcast(chosen), id_col)
        .groupBy(id_col)
        .agg(F.min("_text").alias("_text"), F.min("_y").alias("_y"))
        .orderBy(place, id_col)
        .limit(sample_rows)
        .select("_text", "_y")
        .collect()
    )
    return fit([r["_text"].encode("utf-8", "surrogatepass") for r in rows], [r["_y"] for r in rows])


def _score(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    net = shared.value
    for batch in batches:
        data, offsets = textkit.column_bytes(batch.column("text"))
        out = []
        for lo, hi in textkit.row_slices(offsets):
            base = offsets[lo]
            out.append(score_rows(net, data[base : offsets[hi]], offsets[lo : hi + 1] - base))
        if out:
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(np.concatenate(out).astype(np.float64))], ["doc", "score"])


def score_documents(docs: DataFrame, net: Net, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (probability of label 1), from the text alone.

    Null and empty texts score as texts without bytes; texts of any length are
    scored whole; repeated rows score alike; a column named ``score`` is
    replaced; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(lambda it: _score(it, shared), T.StructType([rows.schema["doc"], T.StructField("score", T.DoubleType())]))
    return out.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns if c != "score"], "score")
