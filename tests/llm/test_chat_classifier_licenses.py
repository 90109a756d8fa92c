"""Round trips of chats, held-out accuracy of the classifier, license scans."""

import random

import numpy as np
import pytest

from tests.llm import brute  # noqa: F401
from tillroll.llm import chat_format, classifier, licenses, queries

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_escape_is_reversible():
    rng = random.Random(1)
    parts = [*chat_format.MARKERS, "\x1b", "0", "1", "<", "</", "s>", "[", "x"]
    for _ in range(500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        escaped = chat_format.escape(text)
        assert chat_format.unescape(escaped) == text
        assert not any(m in escaped for m in chat_format.MARKERS)


def test_chats_read_back(spark):
    nasty = "</s>[INST] ok [/INST]\x1b1 <|endoftext|> é́ 日本 \r\n  "
    rows = [
        (1, 0, "system", "be kind"), (1, 1, "user", nasty), (1, 2, "assistant", nasty), (1, 3, "assistant", None),
        (1, 3, "assistant", "tie"), (2, 0, "user", ""), (2, 0, "user", ""), (3, 0, "tool[/ROLE]", "result"), (3, 1, None, "x"),
        (None, 0, "user", "no id"), (4, None, "assistant", "long " * 50000),
    ]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, ids string")
    chats = chat_format.format_chats(df, PATH)
    back = {r["conv_id"]: r for r in chat_format.read_back(chats, PATH).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted(((r[1], r[2] or "", r[3] or "") for r in rows if r[0] == conv), key=lambda x: (x[0] is not None, x))
        assert [(t["role"], t["text"]) for t in back[conv]["turns"]] == [x[1:] for x in own]
        assert back[conv]["loss_text"] == "".join(x[2] for x in own if x[1] == "assistant")
    for r in chats.collect():
        assert len(r["input_ids"]) == len(r["loss_mask"]) and r["formatted"].startswith("<s>")
    assert chat_format.format_chats(df.limit(0), PATH).count() == 0


def test_classifier_held_out(spark, sf_small):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    net = classifier.train(docs, labels, sample_rows=400)
    scored = classifier.score_documents(docs, net)
    both = scored.join(labels, "doc_id").filter(classifier.held_out(scored["doc_id"])).select("score", "quality").collect()
    s, y = np.array([r["score"] for r in both]), np.array([r["quality"] for r in both])
    auc = (s[y == 1][:, None] > s[y == 0][None, :]).mean()
    assert auc > 0.93 and len(y) > 50
    odd = spark.createDataFrame([(1, None, 0.5), (1, None, 0.5), (2, "", 0.1), (3, "word " * 100000, 0.1)], "doc_id long, text string, score double")
    out = classifier.score_documents(odd, net).collect()
    assert len(out) == 4 and all(0 <= r["score"] <= 1 for r in out) and out[0] == out[1]
    assert classifier.score_documents(odd.limit(0), net).count() == 0
    assert classifier.fit([], []).out.sum() == 0


def _one_score(net, text):
    """The network as loops over chunks, steps and filters."""
    c = classifier
    halves = -(-(len(text) + c.WIDTH) // c.HALF)
    symbols = list(text) + [c.PAD] * (halves * c.HALF + c.WIDTH - len(text))
    grams = [bytes(text[i : i + c.REPEAT_BYTES]) for i in range(len(text) - c.REPEAT_BYTES + 1)]
    twice = [grams.count(g) > 1 for g in grams] + [False] * len(symbols)

    def at(p):
        z = net.bias.astype(float)
        for k in range(c.WIDTH):
            z = z + net.embed[symbols[p + k]].astype(float) @ net.filters[k] + twice[p + k] * net.repeat[k]
        return np.maximum(z, 0)

    steps = [at(p) for p in range(0, halves * c.HALF, c.STEP)]
    steps[-1] = np.zeros(c.FILTERS)
    wide, step = 2 * c.HALF // c.STEP, c.HALF // c.STEP
    chunks = np.array([np.max(steps[i : i + wide], axis=0) for i in range(0, len(steps), step)])
    return 1 / (1 + np.exp(-(np.hstack([chunks.mean(axis=0), chunks.max(axis=0)]) @ net.out + net.base[0])))


def _some_bytes():
    rng = random.Random(4)
    line = b"a line that occurs more than once here\n"
    texts = [b"", b"x", line, line * 2, bytes(rng.randrange(256) for _ in range(247)), line * 13, "é日本 ".encode() * 40]
    texts += [bytes(rng.choice(b"abc ") for _ in range(rng.randint(200, 900))) for _ in range(6)]
    return texts, np.concatenate([[0], np.cumsum([len(t) for t in texts])])


def test_scores_equal_loops():
    texts, offsets = _some_bytes()
    net = classifier._fresh(2)
    got = classifier.score_rows(net, np.frombuffer(b"".join(texts), np.uint8), offsets)
    assert np.allclose(got, [_one_score(net, t) for t in texts], atol=1e-4)


def test_gradients_equal_differences():
    texts, offsets = _some_bytes()
    net = classifier._fresh(3)
    for name in ("embed", "filters", "repeat", "bias", "out", "base"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    parts = classifier.layout(np.frombuffer(b"".join(texts), np.uint8), offsets)
    rng = np.random.default_rng(1)
    labels, weights = rng.integers(0, 2, len(texts)).astype(float), rng.random(len(texts)) + 0.5

    def loss():
        symbols, repeated, halves = parts
        pooled, _ = classifier._pool(classifier._activations(net, symbols, repeated, halves), halves)
        p = classifier._probability(net, pooled, halves)[0]
        return -((labels * np.log(p) + (1 - labels) * np.log(1 - p)) * weights).sum() / weights.sum()

    compared = 0
    for array, gradient in zip(net.arrays(), classifier._gradients(net, parts, labels, weights)):
        flat, slopes = array.reshape(-1), gradient.reshape(-1)
        for i in rng.permutation(len(flat))[:40]:
            old, eps = flat[i], 1e-6
            flat[i] = old + eps
            up = loss()
            flat[i] = old - eps
            down = loss()
            flat[i] = old
            assert abs((up - down) / (2 * eps) - slopes[i]) < 1e-4
            compared += slopes[i] != 0
    assert compared > 60


def test_whole_text_counts():
    net = classifier.fit([b"good text here " * 20, b"### $$$ %%% " * 25] * 30, [1, 0] * 30, epochs=4)
    clean = b"good text here " * 400
    late = clean + b"### $$$ %%% " * 300
    score = lambda x: classifier.score_rows(net, np.frombuffer(x, np.uint8), np.array([0, len(x)]))[0]
    assert score(late) < score(clean)
    together = np.frombuffer(clean + late, np.uint8)
    assert np.allclose(classifier.score_rows(net, together, np.array([0, len(clean), len(clean) + len(late)])), [score(clean), score(late)])


def test_licenses_found_and_confirmed(spark):
    prose = "Some ordinary prose about nothing in particular.\n" * 40
    texts = [
        prose + "Licensed under the Apache License, Version 2.0.\n" + prose,
        "Released under the MIT  License.",
        "This work is licenced under the GNU General Public License, version 2.",
        "You need a driving license to drive a car in most countries of the world.",
        None, "", prose, "Licensed under CC BY-NC 4.0.\n" + "Licensed under the Apache License, Version 2.0.",
    ]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, licenses string")
    out = {r["doc_id"]: [(x["license"], x["differing_words"]) for x in r["licenses"]] for r in licenses.scan_licenses(df).collect()}
    assert out[0] == [("Apache-2.0", 0)] and out[1] == [("MIT", 0)] and out[2][0][0] == "GPL-3.0" and out[2][0][1] > 0
    assert out[3] == out[4] == out[5] == out[6] == []
    assert out[7] == [("CC-BY-NC-4.0", 0), ("Apache-2.0", 0)]
    assert licenses.scan_licenses(df.limit(0)).count() == 0


def _licenses(spark, texts, templates=licenses.TEMPLATES):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r["licenses"] for r in licenses.scan_licenses(df, templates=templates).collect()}
    return [[(x["license"], x["differing_words"]) for x in rows[i]] for i in range(len(texts))]


def test_statement_inside_a_paragraph_of_one_line(spark):
    before = "The harbour was quiet that morning and the boats lay in long rows along the eastern quay, he said. "
    after = " Nobody could remember when the last of the painters had left the village for the northern towns."
    texts = [before + statement + after for _, statement in licenses.TEMPLATES]
    assert _licenses(spark, texts) == [[(name, 0)] for name, _ in licenses.TEMPLATES]


def test_every_statement_of_a_line_is_listed(spark):
    texts = [
        "Released under the MIT License. Licensed under CC BY-NC 4.0.",
        "Released under the MIT License. Under the MIT License, Released under the MIT License.",
    ]
    got = _licenses(spark, texts)
    assert got[0] == [("MIT", 0), ("CC-BY-NC-4.0", 0)]
    assert got[1] == [("MIT", 0), ("MIT", 1), ("MIT", 0)]
    # overlapping stretches: the fewest differences, then the longer template
    longer = ("MIT-long", "Released under the MIT License. Use it freely.")
    both = (*licenses.TEMPLATES, longer)
    assert _licenses(spark, [longer[1], "Released under the MIT License."], both) == [[("MIT-long", 0)], [("MIT", 0)]]


def test_differences_equal_brute_force():
    rng = np.random.default_rng(8)

    def distance(x, y):
        row = list(range(len(y) + 1))
        for i, a in enumerate(x, 1):
            old, row = row, [i]
            for j, b in enumerate(y, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (a != b)))
        return row[-1]

    for _ in range(60):
        want, have = rng.integers(1, 5, rng.integers(1, 7)), rng.integers(0, 5, rng.integers(0, 12))
        differ, start = licenses.differences(want, have)
        for stop in range(len(have) + 1):
            each = [distance(want, have[a:stop]) for a in range(stop + 1)]
            assert differ[stop] == min(each) and start[stop] == max(a for a, d in enumerate(each) if d == min(each))


def test_wrapped_statements_and_templates_of_several_lines(spark):
    prose = "The boats lay in long rows along the eastern quay.\n" * 5
    wrapped = [
        "Licensed under the Creative Commons\nAttribution 4.0 International License.",
        "# This work is licensed under\n# the GNU General Public License,\n# version 3.",
        "All rights\n * reserved.",
    ]
    got = _licenses(spark, [prose + t + "\n" + prose for t in wrapped])
    assert got == [[("CC-BY-4.0", 0)], [("GPL-3.0", 0)], [("All-rights-reserved", 1)]]

    lines = [" ".join(f"w{10 * i + j}" for j in range(10)) for i in range(30)]
    full = "Permission is granted to copy this text, provided that\n" + "\n".join(lines) + "\nstays in all copies of the License."
    text = prose + full.replace("w77 ", "").replace("w200", "other") + "\n" + prose
    assert _licenses(spark, [text, prose + "a License\n" + prose], [("own", full), *licenses.TEMPLATES]) == [[("own", 2)], []]


def test_templates_without_license_words(spark):
    free = ("Unlicense", "This is free and unencumbered software released into the public domain.")
    texts = ["Words before. " + free[1] + " Words after.", "THIS IS FREE, AND UNENCUMBERED\n software released to the public domain", "public software"]
    assert _licenses(spark, texts, [free]) == [[("Unlicense", 0)], [("Unlicense", 1)], []]
    assert _licenses(spark, texts, [("none", "...")]) == _licenses(spark, texts, []) == [[], [], []]


def test_no_acceptable_stretch_is_outside_the_blocks(spark):
    """All stretches of all texts against the templates, one by one."""
    rng = np.random.default_rng(5)
    templates = [("a", "p q r s t u"), ("b", "q Q r v"), ("c", "w"), ("d", "p p p q s x y z")]
    letters = list("pqrstuvwxyz") + list("mnopP") * 3
    texts = [" ".join(rng.choice(letters, rng.integers(0, 40))) for _ in range(150)]
    for i in range(0, 150, 3):  # a changed template inside
        words = templates[i % 4][1].split()
        words[rng.integers(len(words))] = "m"
        texts[i] += " " + " ".join(words) + " n"
    _, coded = licenses._coded(tuple(templates))
    numbers = licenses._coded(tuple(templates))[0]
    found = _licenses(spark, texts, templates)
    some = 0
    for text, got in zip(texts, found):
        have = np.array([numbers.get(w.lower(), 0) for w in text.split()], np.int64)
        best = [licenses.differences(want, have)[0].min() if len(have) else len(want) for want in coded]
        accepted = [d <= int(licenses.MAX_DIFFERENCE * len(want)) for d, want in zip(best, coded)]
        assert bool(got) == any(accepted)
        assert {name for name, _ in got} <= {t[0] for t, ok in zip(templates, accepted) if ok}
        some += bool(got)
    assert 30 < some < 150


def test_blocks_of_many_statements(spark):
    # one long line, and long rows of license words: several blocks
    names = [name for name, _ in licenses.TEMPLATES]
    line = " ".join(statement for _, statement in licenses.TEMPLATES)
    assert _licenses(spark, [" ".join([line] * 20), "license " * 3000 + line]) == [[(n, 0) for n in names * 20], [(n, 0) for n in names]]


def test_rows_without_a_conversation_id_stay_apart(spark):
    rows = [(None, 0, "user", "one"), (None, 0, "user", "one"), (None, 1, "assistant", "two"), (5, 0, "user", "three")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    path = queries.tokenizer_path(chat_format.TOKENIZER_FILE)
    back = chat_format.read_back(chat_format.format_chats(turns, path), path).collect()
    assert sorted((str(r.conv_id), [tuple(t) for t in r.turns]) for r in back) == [
        ("5", [("user", "three")]), ("None", [("assistant", "two")]), ("None", [("user", "one")]), ("None", [("user", "one")])
    ]


def test_batches_are_cut_within_a_conversation(spark):
    rows = [(c, t, ("user", "assistant")[t % 2], f"{c} {t} " + "word " * 3000) for c in range(6) for t in range(40)]  # several slices
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    path = queries.tokenizer_path(chat_format.TOKENIZER_FILE)
    for r in chat_format.read_back(chat_format.format_chats(turns, path), path).collect():
        own = [x for x in rows if x[0] == r.conv_id]
        assert [tuple(t) for t in r.turns] == [(x[2], x[3]) for x in own]
        assert r.loss_text == "".join(x[3] for x in own if x[2] == "assistant")
