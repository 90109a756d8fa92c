"""Quality rules and URL rules against plain Python."""

import random
import re
import sys
import time
from collections import Counter

from pyspark.sql import functions as F

from tests.llm import brute
from tillroll.llm import quality_rules as q
from tillroll.llm import url_rules as u

TEXTS = [
    None, "", " \n\t", "one", "a b c d e f g h a b c d e f g h", "x " * 50, "a b c d e f g h i " * 4,
    "### $$$ word | word <b> & %", "line one\nline two\nline one\n\n \nline two\nline one", "é ß\x0bü\x0cÄ\r\nñ \xa0 \u3000x",
    "SHOUTING AT YOU " * 9, "It It It It It hast hast hast hast hast is is is is is on on on on on no no no no no",
]


def _measures(text):
    t = text or ""
    w = brute.WORD.findall(t)
    lines = [x for x in t.split("\n") if brute.WORD.search(x)]
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    seen = Counter(windows)
    hit = {j for i, x in enumerate(windows) if seen[x] > 1 for j in range(i, i + 8)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(hit))


def test_measures_equal_brute_force(spark):
    rng = random.Random(1)
    texts = TEXTS + [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, n_words string")
    texts[0] = "word, " * 90_000 + "and so on"  # a very long text
    df = df.filter("doc_id > 0").unionByName(spark.createDataFrame([(0, texts[0], "clash")], df.schema))
    judged = q.judge(df, measured=True)
    got = {r[0]: tuple(r[1:]) for r in judged.select("doc_id", *q.MEASURES).collect()}
    assert judged.columns == ["doc_id", "text", "failed_rule", *q.MEASURES]
    assert got == {i: _measures(t) for i, t in enumerate(texts)}


def test_order_never_changes_verdicts(spark):
    rng = random.Random(2)
    good = [" ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(60)) for _ in range(20)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS + good + [good[0]])], "doc_id long, text string")
    ordered = q.order_rules(df, sample_rows=20)
    assert sorted(r.name for r in ordered) == sorted(r.name for r in q.RULES)
    forward = df.withColumn("f", q.failed_rule(q.Doc(F.col("text"), q.words(F.col("text"))), q.RULES)).filter("f is null")
    assert sorted(r["doc_id"] for r in q.keep_good(df).collect()) == sorted(r["doc_id"] for r in forward.collect())
    assert q.keep_good(df).columns == df.columns
    assert {r["text"] for r in q.keep_good(df).collect()} == set(good)
    assert q.keep_good(df.limit(0)).count() == 0


def _rejects(name, text):
    n, chars, symbols, dup, repeat = _measures(text)
    t, w = text or "", brute.WORD.findall(text or "")
    lines = [x for x in t.split("\n") if brute.WORD.search(x)]
    return {
        "short": n < 20, "repeats": 100 * repeat > 30 * n, "symbols": 100 * symbols > 10 * n, "dup_lines": 100 * dup > 50 * len(lines),
        "word_length": chars < 2 * n or chars > 15 * n, "shouting": len(re.findall("[A-Z]", t)) > len(re.findall("[a-z]", t)),
        "stutter": 10 * sum(a == b for a, b in zip(w, w[1:])) > 3 * n,
    }[name]


def test_every_rule_equals_plain_python(spark):
    rng = random.Random(7)
    bits = ["ab", "AB", "Abc", "x", "#", "ab\n", "It", "longerwordthanmost", "\n"]
    texts = TEXTS + [" ".join(rng.choice(rng.sample(bits, 3)) for _ in range(rng.randint(0, 90))) for _ in range(150)]
    texts += ["A" * 40 + " " + "a" * 39, "a" * 300 + "A" * 299, "A" * 300 + "b" * 300, "A" * 300 + "é" * 900 + "b" * 301]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    text = F.col("text")
    for known in (False, True):

        def rejects(rule):
            measured = lambda w: F.struct(*[m(q.Doc(text, w)).alias(n) for n, m in q.MEASURES.items()])
            return q.let(q.words(text), lambda w: rule.rejects(q.Doc(text, w, measured(w) if known else None)))

        rules = [rejects(r) for r in q.RULES]
        for row in df.select("doc_id", *rules).collect():
            assert list(row[1:]) == [_rejects(r.name, texts[row[0]]) for r in q.RULES], texts[row[0]]


def test_first_failed_rule_is_named_and_clashing_column_gives_way(spark):
    df = spark.createDataFrame([(1, "one two", "mine"), (2, None, "mine")], "doc_id long, text string, failed_rule string")
    got = {r.doc_id: r.failed_rule for r in q.judge(df).collect()}
    assert set(got) == {1, 2} and all(v in {r.name for r in q.RULES} for v in got.values())


def test_sample_is_taken_from_everywhere(spark):
    df = spark.range(40_000).select("id", F.lit("text").alias("text"))
    ids = [r.id for r in q._sampled(df, 1000).collect()]
    assert 800 < len(ids) < 1200 and max(ids) > 35_000 and min(ids) < 5_000


RULES = [
    u.UrlRule("org/", True), u.UrlRule("example.org/es/", False), u.UrlRule("example.org/en/1", False),
    u.UrlRule("com/fr/", True), u.UrlRule("com/de/", False), u.UrlRule("a.example.org/", False),
    u.UrlRule("a.example.org/es/", True), u.UrlRule("xample.org/", False),
]


def _judge(url):
    url = url or ""
    if "://" not in url:
        return "", "", None, True
    rest = url.split("://", 1)[1]
    host = brute.ascii_lower(re.match(r"[^/?#]*", rest).group())
    path = re.match(r"[^/?#]*([^?#]*)", rest, re.S).group(1)
    fits = [
        r for r in RULES
        if (host == r.host or host.endswith("." + r.host)) and (path.startswith(r.path) or r.path == "/")
    ]
    best = max(fits, key=lambda r: (len(r.prefix), r.prefix, r.allow), default=None)
    return host, path, best.prefix if best else None, best.allow if best else True


def test_url_rules_equal_brute_force(spark):
    rng = random.Random(4)
    hosts = ["org", "com", "example.org", "a.example.org", "b.a.example.org", "myexample.org", "xample.org", "EXAMPLE.org:80",
             "example.com", "", ".org", "orga", "net", "user@example.org", "example.org."]
    paths = ["", "/", "/es", "/es/", "/es/1", "/en/1", "/en/12", "/en/2", "/fr/x", "/de/", "/DE/", "?x=/es/", "#/es/", "/es?y", "//es/"]
    urls = [f"{rng.choice(['http', 'https', ''])}://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(300)]
    urls += [None, "", "example.org/es/", "http:/x", "http://a://b/c", "http://org\n/x"]
    rows = [(i, x, "clash") for i, x in enumerate(urls)] + [(0, urls[0], "clash")]
    df = spark.createDataFrame(rows, "page_id long, url string, path string")
    got = sorted(
        ((r["page_id"], r["host"], r["path"], r["rule"], r["allowed"]) for r in u.judge_urls(df, RULES, salts=3).collect()), key=str
    )
    assert got == sorted(((i, *_judge(x)) for i, x, _ in rows), key=str)
    assert u.judge_urls(df.limit(0), RULES).count() == 0
    assert {r["rule"] for r in u.judge_urls(df, []).collect()} == {None}


def test_sweep_over_many_chunks_equals_brute_force(spark, monkeypatch):
    rng = random.Random(6)
    label = lambda: rng.choice(["a", "b", "c", "-", "a-", "é"])
    hosts = [".".join(label() for _ in range(rng.randint(1, 4))) for _ in range(400)]
    rules = [u.UrlRule(f"{rng.choice(hosts)}/{rng.choice(['', 'x', 'x/', 'y'])}", rng.random() < 0.5) for _ in range(300)]
    rules = list({r.prefix: r for r in rules}.values())
    rows = [(i, f"http://{rng.choice(['', label() + '.'])}{rng.choice(hosts)}/{rng.choice(['', 'x', 'x/1', 'y', 'z'])}") for i in range(500)]
    monkeypatch.setattr(sys.modules[__name__], "RULES", rules)
    df = spark.createDataFrame(rows, "page_id long, url string")
    for chunk in (1, 7, 64):
        monkeypatch.setattr(u, "CHUNK", chunk)
        got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["allowed"]) for r in u.judge_urls(df, rules, salts=2).collect()}
        assert got == {i: _judge(x) for i, x in rows}


def test_sweep_of_many_rules_is_not_quadratic(spark):
    rules = [u.UrlRule(f"s{i % 7}.h{i}.d{i % 100}.org/p", i % 2 == 0) for i in range(16_000)]
    began = time.monotonic()
    assert u.segments(spark, rules).count() == 32_000
    assert time.monotonic() - began < 60  # the sweep with one growing array took over 200 s


def test_ties_go_to_the_greater_prefix_and_to_allow(spark):
    rules = [u.UrlRule("b.c/", False), u.UrlRule("c/x/", False), u.UrlRule("d/", False), u.UrlRule("d/", True)]
    df = spark.createDataFrame([(1, "http://b.c/x/"), (2, "http://d/"), (3, "http://d/" + "y/" * 200_000)], "page_id long, url string")
    got = {r["page_id"]: (r["rule"], r["allowed"]) for r in u.judge_urls(df, rules, salts=2).collect()}
    assert got == {1: ("c/x/", False), 2: ("d/", True), 3: ("d/", True)}
