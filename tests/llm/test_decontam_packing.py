"""Decontamination and packing against brute force and round trips."""

import random

import numpy as np
import pytest

from tests.llm import brute
from tillroll.llm import decontam, packing

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def _corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["Éa", "b", "C3", "déf", "x", "y", "zz", "日本"])
    items = [(i, " ".join(word() for _ in range(rng.randint(0, 14)))) for i in range(12)]
    items += [(3, "b x"), (None, "quite unique item words"), (50, None), (51, " .. "), (items[0])]
    docs = []
    for _ in range(50):
        words = [word() for _ in range(rng.randint(0, 50))]
        if rng.random() < 0.5:
            words[3:3] = (rng.choice(items)[1] or "").split()
        docs.append("".join(w + rng.choice([" ", ", ", "-", "\n", " \x7f"]) for w in words))
    return items, docs + [None, "", "...", "Quite  UNIQUE item-words"]


def _expected(text, items, window):
    words = brute.ALNUM_WORD.findall(brute.ascii_lower(text or ""))
    hit, ids = set(), set()
    for name, t in items:
        w = brute.ALNUM_WORD.findall(brute.ascii_lower(t or ""))
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            for j in range(len(words) - size + 1):
                if words[j : j + size] == w[i : i + size]:
                    hit.update(range(j, j + size))
                    ids.add("" if name is None else str(name))
    return len(words), len(hit), sorted(ids)


@pytest.mark.parametrize("piece", [1 << 20, 40])
def test_leaks_equal_brute_force(spark, piece, monkeypatch):
    items, docs = _corpus(piece)
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(i, t, "clash") for i, t in enumerate(docs)] + [(0, docs[0], "clash")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    if piece < 1 << 20:  # the scan itself, over pieces
        monkeypatch.setattr(decontam, "PIECE_CHARS", piece)
        patterns = [r.pattern for r in decontam.windows_of(bench, "item_id", "text", 4).select("pattern").distinct().collect()]
        auto = decontam._automaton(patterns)
        for t in docs:
            words = decontam.normal_words(t)
            normal = " " + b" ".join(words).decode("latin-1") + " "
            assert sorted(decontam._matches(auto, normal, max(map(len, patterns)))) == sorted(auto.iter(normal))
        return
    out = decontam.find_leaks(df, bench, window=4).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in out) == sorted(
        (i, *_expected(t, items, 4)) for i, t, _ in rows
    )
    for r in out:  # spans cover the hit words in the original text
        inside = sum(len(brute.ALNUM_WORD.findall(brute.ascii_lower(r["text"][s["start"] : s["stop"]]))) for s in r["spans"])
        assert inside == r["n_hit"]
    kept = decontam.drop_leaks(df, bench, window=4)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in out if not r["n_hit"]}


def test_leaks_of_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert decontam.find_leaks(docs, bench).first()["n_hit"] == 0
    assert decontam.find_leaks(docs.limit(0), bench).count() == 0


def test_a_benchmark_over_one_automaton_is_scanned_in_shards(spark):
    items, docs = _corpus(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(docs)], "doc_id long, text string, runs string")
    size = sum(len((t or "").encode()) for _, t in items) * 4
    whole = decontam.find_leaks(df, bench, window=4)
    shards = decontam.find_leaks(df, bench, window=4, max_pattern_bytes=size // 3)
    assert shards.columns == whole.columns and sorted(map(str, shards.collect())) == sorted(map(str, whole.collect()))


def test_text_over_one_piece(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    text = "word " * 300_000 + item + " word" * 100 + " Alpha, " + item[6:]
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = decontam.find_leaks(df, spark.createDataFrame([(1, item)], "item_id long, text string")).first()
    assert len(text) > decontam.PIECE_CHARS and (row["n_words"], row["n_hit"], row["items"]) == (300_122, 22, ["1"])
    assert [text[s["start"] : s["stop"]].split()[-1] for s in row["spans"]] == ["lambda", "lambda"]


def test_word_tokenizer_equals_tokenizer(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "CACHE_WORDS", 300)
    rng = random.Random(2)
    texts = ["", " ", "It's I'LL we've", "<|endoftext|> a<|startoftext|>b", "<|ENDOFTEXT|>", "x\x1cy \x85z\xa0q\u3000w", "ΑΣ ΑΣΑ Σ e\u0301"]
    texts += ["".join(chr(rng.choice([32, 10, rng.randint(33, 126), rng.randint(160, 900), 39])) for _ in range(50)) for _ in range(200)]
    want = [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    tokenizer = packing.WordTokenizer(PATH)
    got = []
    for i in range(0, len(texts), 20):
        got += [x.tolist() for x in tokenizer.encode([t.encode() for t in texts[i : i + 20]])]
    assert got == want


@pytest.mark.parametrize("limits", [packing.Limits(64, 6, 64, 8), packing.Limits(64, 3, 20, 5), packing.Limits()])
def test_packing_is_complete_and_within_limits(spark, limits):
    from tokenizers import Tokenizer

    rng = random.Random(7)
    texts = [" ".join(rng.choice(["alpha", "beta", "x"]) for _ in range(rng.choice([0, 1, 5, 30, 300]))) for _ in range(60)] + [None]
    df = spark.createDataFrame([(i, t, "to be " * (i % 4)) for i, t in enumerate(texts)], "doc_id long, text string, ask string")
    rows = packing.pack_documents(df, PATH, prompt_col="ask", limits=limits).collect()
    encode = Tokenizer.from_file(PATH)
    bins = {}
    for i, t, ask in df.collect():
        own = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"])
        ids = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in own]).tolist()
        head = encode.encode(ask, add_special_tokens=False).ids
        assert ids == head + encode.encode(t or "", add_special_tokens=False).ids + [packing.END_ID]
        assert sum(r["loss_tokens"] for r in own) == len(ids) - len(head)
        assert [r["start"] for r in own] == np.cumsum([0] + [r["length"] for r in own])[:-1].tolist()
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append(r)
    for own in bins.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == np.cumsum([0] + [r["length"] for r in own])[:-1].tolist()
        total = sum(r["length"] for r in own)
        assert total == limits.tokens or total & (total - 1) == 0
        assert total <= limits.tokens and len(own) <= limits.segments + 1 and sum(r["loss_tokens"] for r in own) <= limits.loss_tokens
    assert packing.pack_documents(df.limit(0), PATH).count() == 0


def test_words_with_closing_punctuation_share_an_entry():
    """The letters are one entry, whatever follows them; white space at the
    ends and empty texts give no ids."""
    from tokenizers import Tokenizer

    words, plain = packing.WordTokenizer(PATH), Tokenizer.from_file(PATH)
    texts = ["alphaish alphaish, alphaish. Alphaish!?", "", " \n", "\talphaish;\x0b ", "großß, 12. a.b, ..., übe:"]
    got = [x.tolist() for x in words.encode([t.encode() for t in texts])]
    assert got == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert not {b"alphaish,", b"alphaish.", b"alphaish!?"} & set(words.known) and b"alphaish" in words.known
