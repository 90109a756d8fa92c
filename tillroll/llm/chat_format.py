"""Chat formatting by token-level assembly.

Every turn's text is escaped, encoded on its own and spliced between reserved
ids that no text can produce, so no merge crosses a marker and no text can
forge one. A conversation's loss spans follow from prefix sums over the
lengths of its segments. ``read_back`` parses ids into turns again.

Template: ``<s>``, then per turn an opening marker, the text and a closing
marker; a role outside the known ones is spelled out between ``[ROLE]`` and
``[/ROLE]``. Control strings inside a text get an escape after their first
character (``ESC 1``; ``ESC`` itself becomes ``ESC 0``), which is undone when
texts are read back.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm import textkit

TOKENIZER_FILE = "byte_bpe_50k.json"
FIRST_RESERVED = 50257
# Markers in the order of their reserved ids.
MARKERS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ASST]", "[ROLE]", "[/ROLE]")
RESERVED = {m: FIRST_RESERVED + i for i, m in enumerate(MARKERS)}
ROLES = {"user": ("[INST]", "[/INST]"), "system": ("<<SYS>>", "<</SYS>>"), "assistant": ("[ASST]", "</s>")}
LOSS_ROLE = "assistant"
FLUSH_IDS = 1 << 17  # ids in a batch that is handed on
ESCAPE = "\x1b"
CONTROL = re.compile("|".join(map(re.escape, (ESCAPE, *MARKERS))))
_ESCAPED = re.compile(f"{ESCAPE}([01])")


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: m[0][0] + (ESCAPE + "1" + m[0][1:] if len(m[0]) > 1 else "0"), text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: ESCAPE if m[1] == "0" else "", text)


@lru_cache(maxsize=1)
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.encode_special_tokens = True
    return found


def _frame(role: str) -> tuple[list[str], str]:
    """Markers before and after a text; a role to spell out is the middle entry."""
    if role in ROLES:
        return [ROLES[role][0]], ROLES[role][1]
    return ["[ROLE]", escape(role), "[/ROLE]"], "</s>"


class _Chats:
    """Finished conversations as flat arrays, handed on when they are many ids."""

    def __init__(self, key_type: pa.DataType) -> None:
        self.key_type = key_type
        self._clear()

    def _clear(self) -> None:
        self.keys: list = []
        self.ids: list[np.ndarray] = []
        self.loss: list[np.ndarray] = []
        self.ends, self.shown = [0], []

    def add(self, key, segments: list[np.ndarray], spans: list[tuple[int, int]], shown: list[str]) -> None:
        ids = np.concatenate(segments)
        edges = np.zeros(len(ids) + 1, np.int32)
        for start, stop in spans:
            edges[start] += 1
            edges[stop] -= 1
        self.keys.append(key)
        self.ids.append(ids)
        self.loss.append(np.cumsum(edges[:-1]).astype(bool))
        self.ends.append(self.ends[-1] + len(ids))
        self.shown.append("".join(shown))

    def full(self) -> bool:
        return self.ends[-1] >= FLUSH_IDS

    def take(self) -> pa.RecordBatch:
        none = [np.zeros(0, np.int32)]
        ends = pa.array(self.ends, pa.int32())
        ids = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(self.ids or none)))
        mask = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(self.loss or none).astype(bool)))
        columns = [pa.array(self.keys, self.key_type), ids, mask, pa.array(self.shown, pa.string())]
        self._clear()
        return pa.RecordBatch.from_arrays(columns, ["conv", "input_ids", "loss_mask", "formatted"])


def _format(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Sorted turns -> conversations. Texts are encoded a bounded slice at a
    time; only the conversation at hand and the finished ones of a batch are
    held, as arrays."""
    tokenizer = _tokenizer(path)
    begin = np.array([RESERVED["<s>"]], np.int32)
    chats = key = None
    segments: list[np.ndarray] = []
    for batch in batches:
        if chats is None:
            chats = _Chats(batch.schema.field("conv").type)
        _, offsets = textkit.column_bytes(batch.column("text"))
        for lo, hi in textkit.row_slices(offsets):
            part = batch.slice(lo, hi - lo)
            texts = [escape(t) for t in part.column("text").to_pylist()]
            encoded = tokenizer.encode_batch(texts, add_special_tokens=False)
            for conv, role, text, found in zip(part.column("conv").to_pylist(), part.column("role").to_pylist(), texts, encoded):
                if not segments or conv is None or conv != key:
                    if segments:
                        chats.add(key, segments, spans, shown)
                        if chats.full():
                            yield chats.take()
                    key, segments, spans, shown, at = conv, [begin], [], ["<s>"], 1
                before, after = _frame(role)
                head = [RESERVED[before[0]]]
                if len(before) > 1:
                    head += [*tokenizer.encode(before[1], add_special_tokens=False).ids, RESERVED[before[2]]]
                ids = np.array([*head, *found.ids, RESERVED[after]], np.int32)
                if role == LOSS_ROLE:
                    spans.append((at + len(head), at + len(ids) - 1))
                at += len(ids)
                segments.append(ids)
                shown += [*before, text, after]
    if segments:
        chats.add(key, segments, spans, shown)
        yield chats.take()


def format_chats(
    turns: DataFrame,
    tokenizer_path: str,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per conversation: ``input_ids``, ``loss_mask`` (true on the ids
    of assistant texts) and ``formatted`` (the rendered template).

    Turns are taken in order of turn number, then role and text, so ties and
    repeated rows stay, side by side. Null roles and texts are empty; a row
    without a conversation id is a conversation of its own. Other columns are
    not used, and an empty table gives no rows.

    Each text is shuffled once. Sorted turns stream through their task, which
    holds one conversation at a time; a conversation becomes one row, as a
    document does.
    """
    rows = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    apart = F.when(F.col("conv").isNull(), F.xxhash64("turn", "role", "text")).otherwise(F.xxhash64("conv"))
    dealt = rows.withColumn("_deal", apart).repartition("_deal").sortWithinPartitions("conv", "turn", "role", "text")
    out = T.StructType([rows.schema["conv"], *T.StructType.fromDDL("input_ids array<int>, loss_mask array<boolean>, formatted string").fields])
    found = dealt.select("conv", "role", "text").mapInArrow(lambda it: _format(it, tokenizer_path), out)
    return found.withColumnRenamed("conv", conv_col)


_NAMES = {i: m for m, i in RESERVED.items()}
_OPENS = {RESERVED[a]: role for role, (a, _) in ROLES.items()}


def parse_ids(ids: np.ndarray, mask: np.ndarray, tokenizer) -> tuple[list[tuple[str, str]], str]:
    """``(turns, text under the mask)`` of one conversation's ids."""
    decode = lambda x: unescape(tokenizer.decode(x.tolist(), skip_special_tokens=False)) if len(x) else ""
    marks = np.flatnonzero(ids >= FIRST_RESERVED)
    turns, loss, role, spelled = [], [], None, False
    for at, end in zip(marks, np.append(marks[1:], len(ids))):
        name, inside = int(ids[at]), ids[at + 1 : end]
        if name in _OPENS:
            role = _OPENS[name]
        elif _NAMES[name] == "[ROLE]":
            role = decode(inside)
            continue
        elif _NAMES[name] != "[/ROLE]":
            continue  # <s> and closing markers
        turns.append((role, decode(inside)))
        if len(inside) and mask[at + 1 : end].all():
            loss.append(turns[-1][1])
    return turns, "".join(loss)


def _read(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    tokenizer = _tokenizer(path)
    kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    for batch in batches:
        ids, mask = batch.column("input_ids"), batch.column("loss_mask")
        ends = np.concatenate([[0], np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False))])
        values, flags = ids.flatten().to_numpy(), mask.flatten()
        for lo, hi in textkit.row_slices(ends, FLUSH_IDS):
            turns, losses = [], []
            inside = flags.slice(ends[lo], ends[hi] - ends[lo]).to_numpy(zero_copy_only=False)
            for r in range(lo, hi):
                a, b = int(ends[r]), int(ends[r + 1])
                found, loss = parse_ids(values[a:b], inside[a - ends[lo] : b - ends[lo]], tokenizer)
                turns.append([{"role": r, "text": t} for r, t in found])
                losses.append(loss)
            part = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays(
                [part.column("conv"), pa.array(turns, kind), pa.array(losses, pa.string()), part.column("formatted")],
                ["conv", "turns", "loss_text", "formatted"],
            )


def read_back(chats: DataFrame, tokenizer_path: str, conv_col: str = "conv_id") -> DataFrame:
    """``turns`` (role, text) and ``loss_text`` recovered from the ids alone."""
    rows = chats.select(F.col(conv_col).alias("conv"), "input_ids", "loss_mask", "formatted")
    out = T.StructType([rows.schema["conv"], *T.StructType.fromDDL("turns array<struct<role:string,text:string>>, loss_text string, formatted string").fields])
    return rows.mapInArrow(lambda it: _read(it, tokenizer_path), out).withColumnRenamed("conv", conv_col)
