"""Conversation prefix trie, built from adaptive radix trees.

A conversation's first turns may come from another one (the first of its block
of twenty), as branches of one dialogue share their beginning. Every distinct
sequence of the first turns of the rebuilt conversations is a node.

1. Turns travel as digests, one shuffle by block, sorted, and stream through a
   task conversation by conversation; no text and no whole conversation is
   held.
2. A task puts a bounded slice of conversations at a time into an adaptive
   radix tree. Keys are the turns' numbers within the slice, four bytes each
   with the highest first. Inner nodes have four layouts by their number of
   children; a stretch without a branch is one compressed path. Only byte
   depths at the end of a turn are trie nodes, also those inside a compressed
   path. A node's id is a chained digest of its turns, so that slices agree.
3. The slices' nodes are added up by id. Slices combine equal prefixes before
   the shuffle, so a very common first turn costs one row a slice.
4. Sums over subtrees: every node belongs to its smallest member, so each is
   counted on one conversation's path; sums from the end of each path are added
   up by node. No iteration over depths is needed.

A conversation longer than a slice is cut: its nodes so far are handed on, and
the next slice goes on below the last of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.session import materialize

BLOCK = 20  # conversations that may share the first turns of the block's first
SLICE_TURNS = 1 << 16  # turns (or conversations) in one tree
BATCH_ROWS = 1 << 13
END_IDS = 1 << 16  # conversation ids of a node that are joined into one text
_STEP = 4  # bytes of a turn's number
ROOT_ID = bytes(16)


class _Node:
    """A radix tree node: the bytes that lead to it from its parent, children
    by their first byte, and the members at or below it."""

    __slots__ = ("path", "keys", "children", "count", "least", "enders", "passing")

    def __init__(self, path: bytes, count: int = 0, least: int | None = None) -> None:
        self.path, self.count, self.least = path, count, least
        self.keys: bytearray | None = bytearray()
        self.children: list = []
        self.enders: list[int] | None = None
        self.passing: int | None = None

    # Layouts: up to 4 and up to 16 children, key bytes beside the children;
    # up to 48, an index of 256 places into the children; above, the children
    # by byte. A layout with an index has 256 keys, the last one has none.

    def layout(self) -> int:
        if self.keys is None:
            return 256
        return 48 if len(self.keys) == 256 else 4 if len(self.keys) <= 4 else 16

    def find(self, byte: int) -> _Node | None:
        keys = self.keys
        if keys is None:
            return self.children[byte]
        if len(keys) == 256:
            at = keys[byte] - 1
        else:
            at = keys.find(byte)
        return self.children[at] if at >= 0 else None

    def add(self, byte: int, child: _Node) -> None:
        keys = self.keys
        if keys is not None and len(keys) == 16:
            index = bytearray(256)
            for at, key in enumerate(keys):
                index[key] = at + 1
            self.keys = keys = index
        elif keys is not None and len(keys) == 256 and len(self.children) == 48:
            self.children = [self.children[at - 1] if at else None for at in keys]
            self.keys = keys = None
        if keys is None:
            self.children[byte] = child
        else:
            self.children.append(child)
            if len(keys) == 256:
                keys[byte] = len(self.children)
            else:
                keys.append(byte)

    def replace(self, byte: int, child: _Node) -> None:
        if self.keys is None:
            self.children[byte] = child
        else:
            self.children[self.keys[byte] - 1 if len(self.keys) == 256 else self.keys.find(byte)] = child


def _shared(a: bytes, b: bytes, start: int) -> int:
    """How many bytes of ``a`` are equal to ``b[start:]``."""
    low, high = 0, min(len(a), len(b) - start)
    while low < high:
        middle = (low + high + 1) // 2
        if b.startswith(a[low:middle], start + low):
            low = middle
        else:
            high = middle - 1
    return low


class RadixTree:
    """Adaptive radix tree over byte keys with path compression."""

    def __init__(self) -> None:
        self.root = _Node(b"")

    def insert(self, key: bytes, member: int, ended: bool = True) -> None:
        """Add a member with this key; one that has not ended goes on beyond it."""
        node, at = self.root, 0
        while True:
            node.count += 1
            if node.least is None or member < node.least:
                node.least = member
            if at == len(key):
                break
            child = node.find(key[at])
            if child is None:
                child = _Node(key[at:])
                node.add(key[at], child)
            elif not key.startswith(child.path, at):
                same = _shared(child.path, key, at)
                upper = _Node(child.path[:same], child.count, child.least)
                child.path = child.path[same:]
                upper.add(child.path[0], child)
                node.replace(key[at], upper)
                child = upper
            at += len(child.path)
            node = child
        if not ended:
            node.passing = member
        elif node.enders is None:
            node.enders = [member]
        else:
            node.enders.append(member)

    def walk(self) -> Iterator[tuple[int, bytearray, _Node]]:
        """``(byte depth before the node's path, all bytes so far, node)``, parents first."""
        stack, key = [(0, self.root)], bytearray()
        while stack:
            start, node = stack.pop()
            del key[start:]
            key += node.path
            yield start, key, node
            stack.extend((len(key), child) for child in node.children if child is not None)


def chained_id(parent: bytes, turn: bytes) -> bytes:
    return hashlib.blake2b(parent + turn, digest_size=16).digest()


class _Rows:
    """Rows of the three kinds, handed on as batches of a bounded size."""

    TYPES = [
        ("kind", pa.int8()), ("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("words", pa.int64()),
        ("n_convs", pa.int64()), ("n_ends", pa.int64()), ("conv", pa.int64()),
    ]
    DDL = "kind tinyint, node binary, parent binary, depth bigint, words bigint, n_convs bigint, n_ends bigint, conv bigint"

    def __init__(self) -> None:
        self.rows: list[tuple] = []

    def full(self) -> bool:
        return len(self.rows) >= BATCH_ROWS

    def take(self) -> pa.RecordBatch:
        columns = zip(*self.rows) if self.rows else [[] for _ in self.TYPES]
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, self.TYPES)], [n for n, _ in self.TYPES])
        self.rows = []
        return batch


_NODE, _PATH, _END = 0, 1, 2


class _Slice:
    """One tree and the numbers of its turns. Below ``top`` (its id, at depth
    ``depth``) if it goes on with a conversation that was cut."""

    def __init__(self, top: bytes = ROOT_ID, depth: int = 0) -> None:
        self.tree, self.top, self.depth = RadixTree(), top, depth
        self.numbers: dict[bytes, int] = {}
        self.turns: list[tuple[bytes, int]] = []  # digest and words by number
        self.size = 0

    def key(self, turns: list[tuple[bytes, int]]) -> bytes:
        out = []
        for turn in turns:
            number = self.numbers.setdefault(turn[0], len(self.turns))
            if number == len(self.turns):
                self.turns.append(turn)
            out.append(number.to_bytes(_STEP, "big"))
        return b"".join(out)

    def insert(self, turns: list[tuple[bytes, int]], conv: int, ended: bool = True) -> None:
        self.tree.insert(self.key(turns), conv, ended)
        self.size += len(turns) + 1

    def rows(self, out: _Rows) -> Iterator[pa.RecordBatch]:
        """The trie nodes of the tree, and the paths of the smallest member
        that ends at a node and of one that goes on."""
        ids = [self.top]
        for start, key, node in self.tree.walk():
            del ids[start // _STEP + 1 :]
            if not start and not node.path and not self.depth:
                out.rows.append((_NODE, ROOT_ID, None, 0, 0, node.count, len(node.enders or ()), node.least))
            for end in range((start // _STEP + 1) * _STEP, len(key) + 1, _STEP):
                digest, words = self.turns[int.from_bytes(key[end - _STEP : end], "big")]
                ids.append(chained_id(ids[-1], digest))
                ended = len(node.enders) if node.enders and end == len(key) else 0
                out.rows.append((_NODE, ids[-1], ids[-2], self.depth + end // _STEP, words, node.count, ended, node.least))
                if out.full():
                    yield out.take()
            for conv in node.enders or ():
                out.rows.append((_END, ids[-1], None, None, None, None, None, conv))
                if out.full():
                    yield out.take()
            paths = [min(node.enders)] if node.enders else []
            for conv in [*paths, *([] if node.passing is None else [node.passing])]:
                for at in range(0 if not self.depth else 1, len(ids)):
                    out.rows.append((_PATH, ids[at], None, self.depth + at, None, None, None, conv))
                    if out.full():
                        yield out.take()


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int, bytes, int]]:
    for batch in batches:
        yield from zip(*[batch.column(c).to_pylist() for c in ("block", "conv", "shared", "digest", "words")])


def _build(batches: Iterator[pa.RecordBatch], slice_turns: int) -> Iterator[pa.RecordBatch]:
    """Turns by block, its first conversation before the others -> rows of the three kinds."""
    out, tree = _Rows(), _Slice()
    block = conv = None
    first: list[tuple[bytes, int]] = []  # the first turns of the block's first conversation
    pending: list[tuple[bytes, int]] = []  # turns of the conversation that are not in a tree yet
    skip = 0

    for b, c, shared, digest, words in _turns(batches):
        if c != conv:
            if conv is not None:
                tree.insert(pending, conv)
                if tree.depth or tree.size >= slice_turns:
                    yield from tree.rows(out)
                    tree = _Slice()
            if b != block:
                block, first = b, []
            conv, skip = c, 0 if c == b else shared
            pending = first[:skip]
        if c == b and len(first) < 3:
            first.append((digest, words))
        if skip:
            skip -= 1
            continue
        if len(pending) >= slice_turns:
            tree.insert(pending, conv, ended=False)
            yield from tree.rows(out)
            top = tree.top
            for turn, _ in pending:
                top = chained_id(top, turn)
            tree, pending = _Slice(top, tree.depth + len(pending)), []
        pending.append((digest, words))
    if conv is not None:
        tree.insert(pending, conv)
        yield from tree.rows(out)
    yield out.take()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joined ids by node, in order -> SHA-256 of all of a node's ids."""
    node, state = None, None
    nodes: list[bytes] = []
    found: list[str] = []
    for batch in batches:
        for key, text in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if key != node:
                if state is not None:
                    nodes.append(node)
                    found.append(state.hexdigest())
                node, state = key, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(found, pa.string())], ["node", "ends_sha256"])
        nodes, found = [], []
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], ["node", "ends_sha256"])


def _ends(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end at each node. A node's ids are joined in
    ranges of ``END_IDS`` numbers, which are spread over tasks; only the joined
    texts of one node meet, one after the other."""
    part = F.floor(F.col("conv") / F.lit(END_IDS))
    joined = ends.groupBy("node", part.alias("part")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids")
    )
    return joined.repartition("node").sortWithinPartitions("node", "part").mapInArrow(_digests, "node binary, ends_sha256 string")


WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def turn_digest(role: Column, text: Column) -> Column:
    """128 bits of the SHA-256 of a turn's role and text."""
    told = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.unhex(F.sha2(told.cast("binary"), 256)), 1, 16)


def prefix_trie(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    slice_turns: int = SLICE_TURNS,
) -> DataFrame:
    """One row per node of the trie of all rebuilt conversations.

    Conversation c (an integer) consists of the first h turns of conversation
    c - c % 20 (a remainder has the sign of c), h being the unsigned crc32 of
    c's decimal modulo 4, and of c's own turns after its first h. Turns are
    ordered by turn (null first), equal ones by the digest of role and text;
    rows repeated in full are turns of their own. Null roles and texts are
    empty. Rows without a conversation id belong to none. Other columns are not
    used. An empty table has no node, not even the root.

    Columns: ``node`` (chained id), ``depth``, ``conv_id`` (smallest member),
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``.
    """
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    conv = F.col(conv_col).cast("bigint")
    rows = turns.filter(conv.isNotNull()).select(
        (conv - conv % F.lit(BLOCK)).alias("block"),
        conv.alias("conv"),
        (F.crc32(conv.cast("string").cast("binary")) % 4).cast("int").alias("shared"),
        F.col(turn_col).alias("turn"),
        turn_digest(role, text).alias("digest"),
        F.regexp_count(text, F.lit(WORD_PATTERN)).cast("bigint").alias("words"),
    )
    streamed = rows.repartition("block").sortWithinPartitions(
        "block", F.col("conv") != F.col("block"), "conv", F.asc_nulls_first("turn"), "digest"
    )
    parts = materialize(streamed.mapInArrow(lambda it: _build(it, slice_turns), _Rows.DDL), "trie-slices")
    nodes = (
        parts.filter(F.col("kind") == _NODE)
        .groupBy("node", "parent", "depth", "words")
        .agg(F.sum("n_convs").alias("n_convs"), F.sum("n_ends").alias("n_ends"), F.min("conv").alias("conv"))
    )
    nodes = materialize(nodes, "trie-nodes")

    # Every node's own share stands on its smallest member's path; from the
    # end of the path upwards these shares add up to the path's part of the
    # sums of all nodes on it.
    shares = nodes.select(
        "conv",
        "depth",
        F.lit(None).cast("binary").alias("node"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
        (F.col("n_convs") == F.col("n_ends")).cast("bigint").alias("leaves"),
    )
    paths = parts.filter(F.col("kind") == _PATH).select(
        "conv", "depth", "node", F.lit(0).cast("bigint").alias("saved"), F.lit(0).cast("bigint").alias("leaves")
    )
    upwards = Window.partitionBy("conv").orderBy(F.col("depth").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    sums = (
        paths.unionByName(shares)
        .select("node", F.sum("saved").over(upwards).alias("saved"), F.sum("leaves").over(upwards).alias("leaves"))
        .filter(F.col("node").isNotNull() & ((F.col("saved") > 0) | (F.col("leaves") > 0)))
        .groupBy("node")
        .agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))
    )
    children = nodes.filter(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    # Joined under a struct, so that both sides are shuffled for this join and
    # adaptive execution can split a parent of very many children.
    above = nodes.filter(F.col("n_convs") > F.col("n_ends")).select(F.struct("node").alias("_up"), F.col("conv").alias("parent_conv_id"))
    told = nodes.join(children, "node", "left").join(sums, "node", "left").join(_ends(parts.filter(F.col("kind") == _END)), "node", "left")
    return (
        told.withColumn("_up", F.struct(F.col("parent").alias("node")))
        .join(above, "_up", "left")
        .select(
            "node",
            "depth",
            F.col("conv").alias("conv_id"),
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"),
            F.coalesce("n_leaves", F.lit(0)).cast("bigint").alias("n_leaves"),
            F.coalesce("saved_tokens", F.lit(0)).cast("bigint").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
    )
