"""Near-duplicate groups against exact all-pairs Jaccard similarity."""

import random

import pytest

from tests.llm import brute
from tillroll.llm import near_dedup, textkit


def _sets(texts):
    out = []
    for t in texts:
        w = brute.WORD.findall(brute.ascii_lower(t or ""))
        out.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set())
    return out


def _components(ids, sets):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            inter = len(sets[i] & sets[j])
            union = len(sets[i] | sets[j])
            if union and 100 * inter >= 75 * union:
                parent[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        r = find(i)
        least[r] = min(least.get(r, d), d)
    return [least[find(i)] for i in range(len(ids))]


def _corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"W{i}" for i in range(300)]
    texts = []
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(6, 200))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 8)):  # chains of edits, around the threshold
            base = list(base)
            for _ in range(max(1, len(base) // rng.choice([15, 30, 60]))):
                base[rng.randrange(len(base))] = rng.choice(vocabulary)
            texts.append((" " if rng.random() < 0.5 else "\n").join(base))
    texts += [None, "", "  \n", "one two", "One  TWO", "one two three", texts[0].lower(), texts[0]]
    rng.shuffle(texts)
    return texts


def test_components_equal_brute_force(spark):
    texts = _corpus(3)
    ids = [3 * i + 1 for i in range(len(texts))]
    df = spark.createDataFrame(list(zip(ids, texts, ids)), "doc_id long, text string, node long")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.link_documents(df).collect()}
    sets = _sets(texts)
    want = {d: (len(s), c, c == d) for d, s, c in zip(ids, sets, _components(ids, sets))}
    assert got == want
    assert len({c for _, c, _ in got.values()}) < len(ids)
    kept = near_dedup.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d, (_, _, k) in want.items() if k)


def test_repeated_rows_null_ids_and_empty(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (None, "x y z")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(str, near_dedup.link_documents(df).collect()))
    assert len(got) == 4 and sum("component_id=5" in g for g in got) == 3
    assert near_dedup.drop_near_duplicates(df).count() == 2
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_dedup.link_documents(empty).collect() == []


def test_estimate_agrees_with_similarity(spark):
    rng = random.Random(5)
    words = [str(rng.random()) for _ in range(2000)]
    other = words[:1700] + [str(rng.random()) for _ in range(300)]
    import numpy as np
    import pyarrow as pa

    from tillroll.llm import textkit

    data, offsets = textkit.column_bytes(pa.array([" ".join(words), " ".join(other)]))
    marks = near_dedup.signatures(near_dedup.minima(*near_dedup.shingle_hashes(data, offsets)))
    a, b = _sets([" ".join(words), " ".join(other)])
    truth = len(a & b) / len(a | b)
    assert abs(near_dedup._estimates(marks[0], marks[1:])[0] - truth) < 0.15
    df = spark.createDataFrame([(marks[0].tolist(), marks[1].tolist())], "a array<bigint>, b array<bigint>")
    native = df.select(near_dedup.estimate("a", "b").alias("e")).first()["e"]
    assert np.isclose(native, near_dedup._estimates(marks[0], marks[1:])[0])


def test_buckets_split_into_cells(spark, monkeypatch):
    # the same groups when every bucket is a grid of cells
    monkeypatch.setattr(near_dedup, "CELL", 2)
    texts = _corpus(11)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.link_documents(df).collect()}
    assert got == dict(enumerate(_components(range(len(texts)), _sets(texts))))


def test_no_cell_grows_with_its_bucket(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(near_dedup, "CELL", 16)
    # bucket 5: a component of 400 texts and 40 outsiders; bucket 6: one component
    name = lambda i: i.to_bytes(4, "big")
    found = spark.createDataFrame([(name(i), [5 if i < 440 else 6]) for i in range(600)], "node binary, bands array<bigint>")
    labels = spark.createDataFrame([(name(i), name(0 if i < 400 else 500)) for i in [*range(400), *range(440, 600)]], "node binary, label binary")
    cells = near_dedup._cells(near_dedup._seats(found, labels), labels)
    largest = cells.groupBy("cell").count().agg(F.max("count")).first()[0]
    assert largest <= 4 * 16
    left, right = cells.filter("is_left").alias("l"), cells.filter("is_member").alias("r")
    met = left.join(right, "cell").select("l.node", F.col("r.node").alias("other"))
    assert met.count() == met.distinct().count() == 40 * 440


def test_signature_bits_collide_independently():
    import numpy as np

    # single shingles with equal and with different low bits: all agree by chance alone
    rng = np.random.default_rng(4)
    hashes = rng.integers(0, 1 << 63, 65, dtype=np.uint64)
    marks = near_dedup.signatures(near_dedup.minima(hashes, np.arange(66)))
    found = near_dedup._estimates(marks[0], marks[1:])
    assert np.abs(found).max() < 0.06


def test_label_join_shuffles_both_sides(spark, monkeypatch):
    from pyspark.sql import functions as F

    rows = [(b"a", 1), (b"a", 2), (b"b", 3)]
    nodes = spark.createDataFrame(rows, "label binary, root bigint").repartition(4)
    least = nodes.groupBy("label").agg(F.min("root").alias("component_id"))
    out = near_dedup._join_label(nodes, least)
    assert sorted((r["root"], r["component_id"]) for r in out.collect()) == [(1, 1), (2, 1), (3, 3)]
    plan = out._jdf.queryExecution().sparkPlan().toString()
    executed = out._jdf.queryExecution().executedPlan().toString()
    # one shuffle for the aggregate and one for each side of the join
    assert "Join" in plan and executed.count("hashpartitioning") >= 3 and executed.count("hashpartitioning(concat(") + executed.count("hashpartitioning(_label") == 2


def test_a_text_over_one_slice(spark):
    rng = random.Random(8)
    words = [f"w{rng.randrange(10**6)}" for _ in range(60_000)]
    edited = list(words)
    for at in range(0, 60_000, 60):  # 5 of 60 shingles differ: similarity 55/65
        edited[at] = "edit"
    far = list(words)
    for at in range(0, 60_000, 20):  # 15/25
        far[at] = "far"
    texts = [" ".join(words), " ".join(edited), " ".join(far), " ".join(words[:100])]
    assert len(texts[0]) > textkit.SLICE_BYTES
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.link_documents(df).collect()}
    assert got == {i: (len(s), c) for i, (s, c) in enumerate(zip(_sets(texts), [0, 0, 2, 3]))}


@pytest.mark.parametrize("block", [1, 3, 1 << 17])
def test_components_by_blocks_of_links(spark, monkeypatch, block):
    """Chains, a star, a loop and a node linked with itself, whatever the
    number of blocks; one block is done after one table."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    tables = []
    write = near_dedup.materialize
    monkeypatch.setattr(near_dedup, "materialize", lambda df, name: (tables.append(name), write(df, name))[1])
    pairs = [(i, i + 1) for i in range(10, 19)] + [(30, 25), (30, 26), (27, 30), (41, 40), (40, 42), (42, 41), (50, 50)]
    name = lambda i: b"%02d" % i
    edges = spark.createDataFrame([(bytearray(name(a)), bytearray(name(b))) for a, b in pairs], "a binary, b binary").repartition(4)
    got = {bytes(r["node"]): bytes(r["label"]) for r in near_dedup.components(edges).collect()}
    least = {**dict.fromkeys(range(10, 20), 10), **dict.fromkeys([25, 26, 27, 30], 25), **dict.fromkeys([40, 41, 42], 40), 50: 50}
    assert got == {name(i): name(k) for i, k in least.items()}
    if block > len(pairs):
        assert tables == ["components-stars"]
