"""Substring removal (bytes and words) against brute force."""

import random
from collections import Counter

import pytest

from tests.llm import brute
from tillroll.llm import phrase_dedup, suffix_dedup, textkit


def _texts(seed: int, alphabet: str, size: int = 40) -> list[str | None]:
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 4)))
    base = [[word() for _ in range(rng.randint(0, 60))] for _ in range(size)]
    passage = [word() for _ in range(30)]
    out: list[str | None] = []
    for i, words in enumerate(base):
        if i % 3 == 0:
            words = words[:10] + passage[rng.randint(0, 12) : rng.randint(14, 30)] + words[10:]
        if i % 7 == 0 and i:
            words = list(base[i - 1])
            if words:
                words[rng.randrange(len(words))] = "edit"
        out.append(rng.choice([" ", "\n", "  "]).join(words))
    out += [None, "", " ", "a", "x" * 150, "x" * 149 + "y", "ab" * 60, "z\0z\0" * 20, out[1], out[1], "é" * 40 + "à"]
    return out


def _frame(spark, texts):
    rows = [(i, t, f"s{i % 3}", i % 5) for i, t in enumerate(texts)]
    rows.append(rows[0])  # a row repeated in full
    return spark.createDataFrame(rows, "doc_id long, text string, source string, kept long"), rows


def _check_bytes(spark, texts, spec):
    df, rows = _frame(spark, texts)
    data = [(r[1] or "").encode() for r in rows]
    flags = brute.covered([list(d) for d in data], spec.window)
    want = sorted(
        (r[0], r[2], bytes(b for b, f in zip(d, fl) if not f), len(d), sum(fl), tuple(brute.runs(fl)))
        for r, d, fl in zip(rows, data, flags)
    )
    got = sorted(
        (r["doc_id"], r["source"], bytes(r["kept"]), r["n_symbols"], r["n_removed"], tuple((s["start"], s["stop"]) for s in r["removed"]))
        for r in suffix_dedup.remove_repeated_bytes(df, spec=spec).collect()
    )
    assert got == want


@pytest.mark.parametrize("seed,window,gram,hot", [(1, 20, 6, 1 << 16), (2, 33, 9, 1 << 16), (3, 20, 5, 3)])
def test_bytes_equal_brute_force(spark, seed, window, gram, hot):
    _check_bytes(spark, _texts(seed, "abé"), suffix_dedup.spec_for(window, gram, hot))


@pytest.mark.parametrize("seed,window,gram,hot", [(4, 7, 3, 1 << 16), (5, 9, 2, 1 << 16), (6, 7, 3, 3)])
def test_words_equal_brute_force(spark, seed, window, gram, hot):
    df, rows = _frame(spark, _texts(seed, "abc"))
    words = [brute.WORD.findall(r[1] or "") for r in rows]
    flags = brute.covered(words, window)
    want = sorted(
        (r[0], " ".join(w for w, f in zip(ws, fl) if not f), len(ws), sum(fl), tuple(brute.runs(fl)))
        for r, ws, fl in zip(rows, words, flags)
    )
    spec = phrase_dedup.spec_for(window, gram, hot)
    got = sorted(
        (r["doc_id"], r["kept"], r["n_symbols"], r["n_removed"], tuple((s["start"], s["stop"]) for s in r["removed"]))
        for r in phrase_dedup.remove_repeated_passages(df, spec=spec).collect()
    )
    assert got == want


def test_production_bytes_and_a_text_over_one_slice(spark):
    rng = random.Random(11)
    noise = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz \n") for _ in range(n))
    passage = noise(260)
    long = noise(150_000) + passage + noise(150_000) + passage[:230] + noise(9)
    texts = [long, noise(50) + passage[30:229] + noise(60), noise(50) + passage[30:230] + noise(60), passage, passage, "é" * 300, noise(199), None, ""]
    texts += [texts[6], "y" * 199, "y" * 199, "z" * 200]
    rows = [(i, t) for i, t in enumerate(texts)]
    data = [(t or "").encode() for t in texts]
    assert len(data[0]) > textkit.SLICE_BYTES
    seen = Counter(d[i : i + 200] for d in data for i in range(len(d) - 199))
    want = []
    for i, d in enumerate(data):
        flags = bytearray(len(d))
        for at in range(len(d) - 199):
            if seen[d[at : at + 200]] > 1:
                flags[at : at + 200] = b"\1" * 200
        want.append((i, bytes(b for b, f in zip(d, flags) if not f), sum(flags), brute.runs([bool(f) for f in flags])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert suffix_dedup.WINDOW_BYTES == 200
    got = sorted(
        (r["doc_id"], bytes(r["kept"]), r["n_removed"], [(s["start"], s["stop"]) for s in r["removed"]])
        for r in suffix_dedup.remove_repeated_bytes(df).collect()
    )
    assert got == want and want[0][2] == 490 and want[1][2] == 0 and want[2][2] == 200


def test_production_words_and_a_text_over_one_slice(spark):
    rng = random.Random(12)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage = words(50)
    texts = [words(30_000) + passage + words(30_000) + passage[:35], words(9) + passage[5:39], words(9) + passage[5:45] + words(3), passage[:35]]
    flags = brute.covered(texts, phrase_dedup.WINDOW_WORDS)
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    assert phrase_dedup.WINDOW_WORDS == 35 and len(" ".join(texts[0])) > textkit.SLICE_BYTES
    got = {r["doc_id"]: (r["kept"], r["n_removed"]) for r in phrase_dedup.remove_repeated_passages(df).collect()}
    assert got == {i: (" ".join(w for w, f in zip(t, fl) if not f), sum(fl)) for i, (t, fl) in enumerate(zip(texts, flags))}
    assert [got[i][1] for i in range(4)] == [80, 0, 40, 35]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.remove_repeated_bytes(empty).collect() == []
    assert phrase_dedup.remove_repeated_passages(empty).collect() == []


def test_maximal_repeats_list_all_occurrences(spark):
    texts = ["qq" + "abcdefghij" * 1 + "xx1", "rr" + "abcdefghij" + "yy2", "ss" + "abcdefghij" + "zz3", "unrelated text"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = suffix_dedup.maximal_repeats(df, spec=suffix_dedup.spec_for(8, 4)).collect()
    longest = max(r["length"] for r in found)
    assert longest == 10
    top = {(r["k1"], r["start"]) for r in found if r["length"] == 10}
    assert len(top) == 3 and {s for _, s in top} == {2}


def _listed(spark, texts, spec):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {}
    for r in suffix_dedup.maximal_repeats(df, spec=spec).collect():
        found.setdefault((r["h"], r["repeat"]), []).append((r["doc"]["doc_id"], r["start"], r["length"]))
    out = sorted(sorted(x) for x in found.values())
    assert all(len(set(x)) == len(x) > 1 for x in out)
    for x in out:
        assert len({texts[d].encode()[s : s + n] for d, s, n in x}) == 1
    return out


def test_maximal_repeats_of_hot_groups_and_copies(spark):
    texts = [t or "" for t in _texts(9, "abc")]
    whole = _listed(spark, texts, suffix_dedup.spec_for(20, 6))
    assert _listed(spark, texts, suffix_dedup.spec_for(20, 6, 2)) == whole
    # the listed occurrences cover what is removed, copies included
    flags = brute.covered([list(t.encode()) for t in texts], 20)
    covered = [[False] * len(f) for f in flags]
    for d, s, n in (x for group in whole for x in group):
        covered[d][s : s + n] = [True] * n
    assert covered == flags

    # a passage in the copies of one text alone, and every copy of another one
    alone = _listed(spark, ["only in two copies", "only in two copies", "something else here"], suffix_dedup.spec_for(8, 4))
    assert alone and all({d for d, _, _ in x} == {0, 1} for x in alone)


def test_prefix_intervals():
    # items: a, ab, abc, abd, b  -> lcp 1 2 2 0
    import numpy as np

    found = set(suffix_dedup.prefix_intervals(np.array([1, 2, 2, 0]), 1))
    assert found == {(2, 1, 3), (1, 0, 3)}
