"""Sequence packing as vector bin packing with a dot-product heuristic.

Documents become token ids (each closed by an end id) and are packed into
sequences under three limits at once: tokens, segments (pieces) and
loss-bearing tokens. A document of a whole sequence or more fills sequences of
its own with cuts at the limits; what remains of it joins a pool. An open
sequence takes, among the pool's pieces that fit, the one whose demand vector
has the largest dot product with what the sequence has left (all in shares of
the limits). When none fits, the largest piece is cut to fill it. A sequence
that cannot be filled (the last one, or one at its segment limit) is split into
sequences of powers of two, which need no padding.

Every task packs its own partition as it streams by, with a pool of bounded
size, so nothing is shuffled and a retried task repeats its result. Sequence
ids are the partition number and a counter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm import textkit

TOKENIZER_FILE = "word_bpe_49k.json"
END_ID = 2
CACHE_WORDS = 500_000
# Bytes of text split at once: larger slices have fewer distinct words in all.
SLICE_BYTES = 1 << 22
_CLOSERS = b".,;:!?"


def _byte_chars() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: a
    visible Latin-1 character is itself, the others follow from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(others)) for b in range(256)]


_BYTE_CHARS = _byte_chars()


@dataclass(frozen=True)
class Limits:
    tokens: int = 4096
    segments: int = 256
    loss_tokens: int = 4096
    pool: int = 256

    def __post_init__(self) -> None:
        if min(self.tokens, self.segments, self.loss_tokens, self.pool) < 1:
            raise ValueError("limits must be positive")


class WordTokenizer:
    """Ids of whole texts from ids of their words.

    For a tokenizer that lower-cases, drops white space and never joins across it
    (its pre-tokenizer splits there), the ids of a text are those of its
    ASCII-white-space-separated words one after the other. The vocabulary is
    byte-level BPE with letters, digits and other characters as separate
    pre-tokens, so a word of letters with closing punctuation is two entries,
    its letters and its tail. Each distinct entry is encoded once; their number
    is bounded.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self._reset()

    def _reset(self) -> None:
        """Entry 0 is empty."""
        self.known: dict[bytes, int] = {b"": 0}
        self.lengths = np.zeros(1, np.int64)
        self.starts = np.zeros(1, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _learn(self, new: list[bytes]) -> None:
        """Words of lower-case Latin letters, which normalisation does not
        change, are encoded by the model alone."""
        parts: list[list[int]] = []
        alone: list[int] = []
        for k, word in enumerate(new):
            if _plain(word):
                chars = word.decode() if word.isascii() else "".join(map(_BYTE_CHARS.__getitem__, word))
                parts.append([t.id for t in self.model.tokenize(chars)])
            else:
                alone.append(k)
                parts.append([])
        texts = [new[k].decode("utf-8", "replace") for k in alone]
        for k, found in zip(alone, self.tokenizer.encode_batch(texts, add_special_tokens=False)):
            parts[k] = found.ids
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        flat = np.fromiter(chain.from_iterable(parts), np.uint32, int(lengths.sum()))
        self.starts = np.concatenate([self.starts, len(self.pool) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.pool = np.concatenate([self.pool, flat])
        for w in new:
            self.known[w] = len(self.known)

    def _entries(self, words: list[bytes]) -> np.ndarray:
        """The two entries of each word, one after the other."""
        entries: list[bytes] = []
        for word in words:
            if word[-1:] in _CLOSERS and _plain(core := word.rstrip(_CLOSERS)):
                entries += (core, word[len(core) :])
            else:
                entries += (word, b"")
        number = np.fromiter(map(self.known.get, entries, repeat(-1)), np.int64, len(entries))
        if len(number) and number.min() < 0:
            new = {entries[k] for k in np.flatnonzero(number < 0).tolist()}
            if len(self.known) + len(new) > CACHE_WORDS:
                self._reset()
                new = set(entries) - {b""}
            self._learn(list(new))
            number = np.fromiter(map(self.known.__getitem__, entries), np.int64, len(entries))
        return number

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        if not texts:
            return []
        # The tokenizer lower-cases; doing it here makes fewer distinct words.
        # Left as they are: texts that may hold a special token's string, or
        # combining marks (U+0300-036F), which compose before lower-casing.
        lowered = [t if b"<|" in t or b"\xcc" in t or b"\xcd" in t else t.lower() for t in texts]
        # white space at a text's ends makes an empty word there
        split = pc.ascii_split_whitespace(pa.array(lowered, pa.large_binary()).cast(pa.large_string(), safe=False))
        sizes = pc.list_value_length(split).to_numpy()
        coded = pc.list_flatten(split).cast(pa.large_binary()).dictionary_encode()
        # the slice's distinct words in a pool of their own, then its words
        pairs = self._entries(coded.dictionary.to_pylist())
        local, lengths = _gather(self.pool, self.starts[pairs], self.lengths[pairs])
        lengths = lengths.reshape(-1, 2).sum(axis=1)
        number = coded.indices.to_numpy()
        ids, lengths = _gather(local, (np.cumsum(lengths) - lengths)[number], lengths[number])
        cuts = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum(sizes)]
        return np.split(ids, cuts[:-1])


def _plain(word: bytes) -> bool:
    """Lower-case Latin letters only."""
    if word.isascii():
        return word.isalpha() and word.islower()
    text = word.decode("utf-8", "replace")
    return text.isalpha() and max(text) <= "\u024f" and text == text.lower()


def _gather(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``pool[start:start+length]`` of all spans one after the other, and the lengths."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)], lengths


@lru_cache(maxsize=1)
def _tokenizer(path: str) -> WordTokenizer:
    """One tokenizer for all tasks of a worker process, so its cache stays warm."""
    return WordTokenizer(path)


@dataclass
class _Piece:
    """``ids[start:start+length]`` of a document; ``quiet`` of its leading ids bear no loss."""

    doc: int
    start: int
    length: int
    quiet: int

    def loss(self, length: int | None = None) -> int:
        length = self.length if length is None else length
        return max(0, self.start + length - max(self.quiet, self.start))


class _Packer:
    """Pieces that wait for a bin, with their demands in fixed arrays."""

    def __init__(self, limits: Limits, first_id: int):
        self.limits, self.next_id = limits, first_id
        room = limits.pool + 2
        self.size = 0
        self.pool: list[_Piece | None] = [None] * room
        self.demand = np.zeros((room, 3))
        self.silent = np.zeros(room)  # leading ids without loss
        self.docs: dict[int, tuple[object, np.ndarray]] = {}
        self.waiting: dict[int, int] = {}  # pieces of a document not yet placed
        self.scale = np.array([limits.tokens, limits.segments, limits.loss_tokens], float)

    def _rooms(self, piece: _Piece, tokens: int, loss: int) -> int:
        """Longest prefix of the piece within the given room."""
        silent = max(0, min(piece.quiet - piece.start, piece.length))
        return min(piece.length, tokens, silent + loss)

    def _push(self, piece: _Piece) -> None:
        self.waiting[piece.doc] = self.waiting.get(piece.doc, 0) + 1
        at = self.size
        self.pool[at] = piece
        self.demand[at] = piece.length, 1, piece.loss()
        self.silent[at] = max(0, min(piece.quiet - piece.start, piece.length))
        self.size += 1

    def _take(self, at: int) -> _Piece:
        piece, last = self.pool[at], self.size - 1
        self.pool[at], self.pool[last] = self.pool[last], None
        self.demand[at], self.silent[at] = self.demand[last], self.silent[last]
        self.size = last
        return piece

    def _emit(self, bin_: list[_Piece], full: bool) -> Iterator[tuple]:
        """Rows of a sequence; of several of powers of two if it is not full."""
        total = sum(p.length for p in bin_)
        sizes = [total] if full else [1 << b for b in range(total.bit_length() - 1, -1, -1) if total >> b & 1]
        pieces = iter(bin_)
        piece = None
        for size in sizes:
            at = 0
            while at < size:
                if piece is None:
                    piece = next(pieces)
                take = min(piece.length, size - at)
                key, ids = self.docs[piece.doc]
                yield key, piece.start, take, ids[piece.start : piece.start + take], len(ids), self.next_id, at, piece.loss(take)
                at += take
                piece = _Piece(piece.doc, piece.start + take, piece.length - take, piece.quiet) if take < piece.length else None
            self.next_id += 1
        for p in bin_:
            self.waiting[p.doc] -= 1
            if not self.waiting[p.doc]:
                del self.docs[p.doc], self.waiting[p.doc]

    def add(self, number: int, key: object, ids: np.ndarray, quiet: int) -> Iterator[tuple]:
        self.docs[number] = (key, ids)
        piece = _Piece(number, 0, len(ids), quiet)
        self.waiting[number] = 1  # held until the document is cut
        while piece.length >= self.limits.tokens:
            take = self._rooms(piece, self.limits.tokens, self.limits.loss_tokens)
            cut = _Piece(number, piece.start, take, quiet)
            self.waiting[number] += 1
            yield from self._emit([cut], take == self.limits.tokens)
            piece = _Piece(number, piece.start + take, piece.length - take, quiet)
        if piece.length:
            self._push(piece)
        self.waiting[number] -= 1
        if not self.waiting[number]:
            del self.docs[number], self.waiting[number]
        while self.size >= self.limits.pool:
            yield from self._fill()

    def _fill(self) -> Iterator[tuple]:
        left = self.scale.copy()
        chosen: list[_Piece] = []
        while self.size and left[0] and left[1]:
            demand = self.demand[: self.size]
            fits = np.flatnonzero((demand <= left).all(axis=1))
            if len(fits):
                score = (demand[fits] / self.scale) @ (left / self.scale)
                piece = self._take(int(fits[score.argmax()]))
            else:
                rooms = np.minimum(np.minimum(demand[:, 0], left[0]), self.silent[: self.size] + left[2])
                at = int(rooms.argmax())
                take = int(rooms[at])
                if not take:
                    break
                whole = self._take(at)
                piece = _Piece(whole.doc, whole.start, take, whole.quiet)
                self._push(_Piece(whole.doc, whole.start + take, whole.length - take, whole.quiet))
            chosen.append(piece)
            left -= [piece.length, 1, piece.loss()]
        yield from self._emit(chosen, left[0] == 0)

    def finish(self) -> Iterator[tuple]:
        while self.size:
            yield from self._fill()


_RESULT = (
    "start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint, loss_tokens bigint"
)


def _batch(rows: list[tuple], doc_type: pa.DataType) -> pa.RecordBatch:
    key, start, length, ids, total, sequence, at, loss = zip(*rows)
    ends = np.concatenate([[0], np.cumsum(np.array(length) * 4)]).astype(np.int32)
    flat = np.concatenate(ids).astype("<u4")
    binary = pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(flat)])
    return pa.RecordBatch.from_arrays(
        [pa.array(key, doc_type), *(pa.array(x, pa.int64()) for x in (start, length)), binary]
        + [pa.array(x, pa.int64()) for x in (total, sequence, at, loss)],
        ["doc", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "loss_tokens"],
    )


def _texts(column: pa.Array) -> tuple[memoryview, list[int], np.ndarray]:
    data, offsets = textkit.column_bytes(column)
    return memoryview(data), offsets.tolist(), offsets


def _pack(batches: Iterator[pa.RecordBatch], path: str, end_id: int, limits: Limits) -> Iterator[pa.RecordBatch]:
    tokenizer = _tokenizer(path)
    packer = _Packer(limits, TaskContext.get().partitionId() << 40)
    end, none = np.array([end_id], np.uint32), np.zeros(0, np.uint32)
    number, rows, doc_type = 0, [], None
    for batch in batches:
        docs = batch.column("doc")
        doc_type = docs.type
        raw, at, offsets = _texts(batch.column("text"))
        prompted = "prompt" in batch.schema.names
        if prompted:
            head, cuts, _ = _texts(batch.column("prompt"))
        for lo, hi in textkit.row_slices(offsets, SLICE_BYTES):
            ids = tokenizer.encode([bytes(raw[at[r] : at[r + 1]]) for r in range(lo, hi)])
            before = tokenizer.encode([bytes(head[cuts[r] : cuts[r + 1]]) for r in range(lo, hi)]) if prompted else repeat(none)
            for key, own, quiet in zip(docs.slice(lo, hi - lo).to_pylist(), ids, before):
                rows += packer.add(number, key, np.concatenate([quiet, own, end]), len(quiet))
                number += 1
            if len(rows) >= 1024:
                yield _batch(rows, doc_type)
                rows = []
    rows += packer.finish()
    if rows:
        yield _batch(rows, doc_type)


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    prompt_col: str | None = None,
    end_id: int = END_ID,
    limits: Limits = Limits(),
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start`` (ids of its document before it),
    ``length``, ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``,
    ``sequence_id``, ``offset`` (gapless in its sequence), ``loss_tokens``.

    ``prompt_col`` is text before the document whose ids bear no loss. Null
    texts are empty and become the end id alone. Repeated rows are packed as
    documents of their own, null ids pass through, other columns are not used,
    and an empty table gives no pieces. ``tokenizer_path`` must be readable on
    every executor and drop white space (see ``WordTokenizer``).
    """
    prompt = [F.col(prompt_col).cast("string").alias("prompt")] if prompt_col else []
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"), *prompt)
    schema = T.StructType([rows.schema["doc"], *T.StructType.fromDDL(_RESULT).fields])
    return rows.mapInArrow(lambda it: _pack(it, tokenizer_path, end_id, limits), schema).withColumnRenamed("doc", id_col)
