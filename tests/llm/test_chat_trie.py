"""The conversation prefix trie against a plain version, and its radix tree."""

import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.llm import chat_trie as ct

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(rows):
    turns = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns.setdefault(c, []).append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in turns.items()}
    out = {}
    for c, ts in own.items():
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(base, [])[:h] + ts[h:]
    return out


def plain(rows):
    convs = rebuilt(rows)
    nodes = {}
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(tuple(ts[:d]), []).append(c)
    words = {n: len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) if n else 0 for n in nodes}
    kids = {n: sum(len(m) == len(n) + 1 and m[: len(n)] == n for m in nodes) for n in nodes}
    out = []
    for n, members in nodes.items():
        under = [m for m in nodes if m[: len(n)] == n]
        ends = ",".join(str(c) for c in sorted(members) if len(convs[c]) == len(n))
        out.append((
            min(members), len(n), min(nodes[n[:-1]]) if n else None, len(members), kids[n],
            sum(kids[m] == 0 for m in under), sum((len(nodes[m]) - 1) * words[m] for m in under),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def trie(df, **options):
    return sorted((tuple(r) for r in ct.prefix_trie(df, **options).select(COLUMNS).collect()), key=str)


def some_rows(seed, convs=70, texts=3, longest=7):
    rng = random.Random(seed)
    ids = rng.sample(range(-45, 120), convs)
    return [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a b c", "d", "", None, "e\tf"][:texts + 1])) for c in ids for t in range(rng.randint(1, longest))]


@pytest.mark.parametrize("slice_turns", [2, 5, 1 << 16])
def test_trie_equals_the_plain_version(spark, slice_turns):
    rows = some_rows(1)
    rows += [(500, None, "user", "first"), (500, 0, "user", "second"), (500, None, "user", "first"), (None, 1, "user", "none")]
    rows += [(700 + i, t, "user", "same") for i in range(30) for t in range(4)]  # copies of one conversation
    rows += [(800, t, "user", f"long {t % 3}") for t in range(40)] + [(801, t, "user", f"long {t % 3}") for t in range(35)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("node", F.lit(1)).withColumn("depth", F.lit("mine")).repartition(4)
    assert trie(df, slice_turns=slice_turns) == plain(rows)


@pytest.mark.parametrize("seed", range(4))
def test_bases_absent_and_short(spark, seed):
    rows = some_rows(seed + 10, convs=50, texts=2, longest=3)
    assert trie(spark.createDataFrame(rows, SCHEMA), slice_turns=16) == plain(rows)


def test_empty_table_and_ids_missing(spark):
    assert trie(spark.createDataFrame([], SCHEMA)) == []
    assert trie(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)) == []


def test_conversation_left_without_turns_is_a_member_of_the_root(spark):
    c = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(c, 0, "user", "gone")]
    assert trie(spark.createDataFrame(rows, SCHEMA)) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_long_conversation_goes_through_in_slices(spark):
    rows = [(0, t, "user", f"turn {t}") for t in range(3000)] + [(20, t, "user", f"turn {t}" if t < 2500 else "other") for t in range(2600)]
    got = trie(spark.createDataFrame(rows, SCHEMA), slice_turns=64)
    root = [r for r in got if r[1] == 0]
    shared = 2500  # both begin alike: conversation 20 is its own block's first
    assert len(got) == 3001 + 100
    assert root[0][3:7] == (2, 1, 2, 2 * shared)
    assert max(r[1] for r in got) == 3000


def test_very_many_members_ending_at_one_node(spark):
    n = 150_000  # three ranges of ids
    df = spark.range(0, n * 20, 20).select(F.col("id").alias("conv_id"), F.lit(0).alias("turn"), F.lit("user").alias("role"), F.lit("hi").alias("text"))
    got = trie(df, slice_turns=1 << 12)
    ends = hashlib.sha256(",".join(str(c) for c in range(0, n * 20, 20)).encode()).hexdigest()
    empty = hashlib.sha256(b"").hexdigest()
    assert got == sorted([(0, 0, None, n, 1, 1, n - 1, empty), (0, 1, 0, n, 0, 1, n - 1, ends)], key=str)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(max_size=6), min_size=1, max_size=80))
def test_radix_tree_keeps_every_key(keys):
    tree = ct.RadixTree()
    for i, key in enumerate(keys):
        tree.insert(key, i)
    found, counts = {}, {}
    for start, key, node in tree.walk():
        assert node.path or not start
        found.update({bytes(key): node.enders} if node.enders else {})
        counts[bytes(key)] = (node.count, node.least)
    assert found == {k: [i for i, x in enumerate(keys) if x == k] for k in keys}
    for prefix, (count, least) in counts.items():
        members = [i for i, x in enumerate(keys) if x.startswith(prefix)]
        assert (count, least) == (len(members), min(members))


def test_layouts_grow_with_the_children():
    tree = ct.RadixTree()
    seen = []
    for b in random.Random(1).sample(range(256), 256):
        tree.insert(bytes([b, 7]), b)
        seen.append(tree.root.layout())
    assert [seen.count(k) for k in (4, 16, 48, 256)] == [4, 12, 32, 208]
    assert all(tree.root.find(b).path == bytes([b, 7]) for b in range(256))
