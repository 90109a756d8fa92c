"""The corpus pipeline, stage by stage, against brute force on a small corpus."""

import random

import numpy as np
import pytest

import corpus_pipeline
from tests.llm import brute
from tests.llm.test_decontam_packing import _expected
from tests.llm.test_near_dedup import _components, _sets

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijk") for _ in range(rng.randint(2, 8)))
    passage = " ".join(word() for _ in range(60))
    items = [(i, " ".join(word() for _ in range(25))) for i in range(4)]
    texts = []
    for i in range(40):
        words = [word() for _ in range(rng.randint(30, 200))]
        if i % 5 == 0:
            words[10:10] = passage.split()
        if i % 8 == 0:
            words[5:5] = items[i % 4][1].split()[:15]
        texts.append("\n".join(" ".join(words[k : k + 12]) for k in range(0, len(words), 12)))
    near = texts[3].split(" ")
    near[4] = "changed"
    texts += [" ".join(near), texts[7], "too short", "### $$$ " * 40, None, "", "echo " * 60, passage]
    rows = [(100 + i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, items


def test_stages_equal_brute_force(spark, corpus):
    from tests.llm.test_quality_url_rules import _measures

    path, rows, items = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "substring_dedup", "decontamination", "packing"]

    def apply(name, df):
        out = stages[name](spark, df, path)
        if name != "packing":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        return spark.createDataFrame(out.collect(), out.schema)

    df = apply("quality_rules", docs)
    junk = {r[0] for r in rows if _measures(r[1])[0] < 20 or (r[1] or "").startswith(("###", "echo"))}
    want = {r[0]: r[1] for r in rows if r[0] not in junk}
    assert {r["doc_id"]: r["text"] for r in df.collect()} == want

    df = apply("near_dedup", df)
    ids = sorted(want)
    groups = _components(ids, _sets([want[i] for i in ids]))
    want = {i: want[i] for i, c in zip(ids, groups) if i == c}
    assert {r["doc_id"]: r["text"] for r in df.collect()} == want and len(want) < len(ids)

    df = apply("substring_dedup", df)
    ids = sorted(want)
    words = [want[i].split() for i in ids]
    cut = {}
    for i, w, flags in zip(ids, words, brute.covered(words, 35)):
        if not all(flags):
            cut[i] = [x for x, f in zip(w, flags) if not f]
    got = {r["doc_id"]: r for r in df.collect()}
    assert {i: r["text"].split() for i, r in got.items()} == cut and len(cut) < len(want)
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    untouched = [i for i in cut if len(cut[i]) == len(want[i].split())]
    assert untouched and all(got[i]["text"] == want[i] for i in untouched)

    df = apply("decontamination", df)
    texts = {i: r["text"] for i, r in got.items()}
    want = {i: t for i, t in texts.items() if not _expected(t, items, 10)[1]}
    assert {r["doc_id"]: r["text"] for r in df.collect()} == want and 0 < len(want) < len(texts)

    pieces = corpus_pipeline.run(spark, path).collect()
    assert {r["doc_id"] for r in pieces} == set(want)
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for i, t in want.items():
        total = len(encode.encode(t, add_special_tokens=False).ids) + 1
        assert sum(r["length"] for r in pieces if r["doc_id"] == i) == total
    sizes = {}
    for r in pieces:
        sizes[r["sequence_id"]] = sizes.get(r["sequence_id"], 0) + r["length"]
    assert all(n == 4096 or n & (n - 1) == 0 for n in sizes.values()) and np.sum(list(sizes.values())) > 0


def test_empty_corpus(spark, corpus):
    path, _, _ = corpus
    df = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, path)
        assert out.count() == 0
        df = out if set(df.columns) <= set(out.columns) else df


def test_clashing_columns_and_repeated_rows_keep_their_values(spark, corpus):
    path, rows, _ = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    docs = docs.unionByName(docs.filter("doc_id = 102")).selectExpr(
        "*", "'mine' AS kept", "7 AS n_removed", "8L AS n_symbols", "'x' AS removed", "'y' AS failed_rule", "'z' AS items", "doc_id AS _row"
    )
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        docs = spark.createDataFrame(out.collect(), out.schema)
    got = docs.collect()
    assert got and all((r.kept, r.n_removed, r.n_symbols, r.removed, r.failed_rule, r.items, r._row) == ("mine", 7, 8, "x", "y", "z", r.doc_id) for r in got)
    assert sum(r.doc_id == 102 for r in got) == 1
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, path)
    assert "ids" in packed.columns and all(len(r.ids) == 4 * r.length for r in packed.collect())
