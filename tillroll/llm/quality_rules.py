"""Quality rules as a short-circuit cascade of native expressions.

Each rule is a boolean SQL expression that is true for a text to reject. The
rules' costs (least of several timed passes over a sample, less the cost of an
empty pass) and rejection shares are estimated on the same bounded sample, and
the rules are tried in the order of rejections per second. ``CASE`` evaluates
its branches in order and stops at the first that holds, so later rules run
only for texts that earlier ones let through. The order changes the cost and
the rule that a rejection is booked under, never the verdict.

A text is split into words once, whatever rules read them; measures that are
asked for as columns are not computed again by the rules.

A null text has no words and is rejected as short; an empty table gives an
empty result; repeated rows are judged alike; texts are scanned whole. An input
column of a result's name (``failed_rule``) gives way to it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space, words and symbols of the base measures.
SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOL_CHARS = "#*$%&|<>"
REPEAT_WINDOW = 8

SAMPLE_ROWS = 2_000
TIMED_RUNS = 3


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.transform(F.array(value), body)[0]


def _text(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    trimmed = F.btrim(_text(text), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{SPACE_CHARS}]+", -1))


class Doc:
    """A text, its words and the measures of both. ``known`` measures are taken
    as they are, others are computed where they are asked for."""

    def __init__(self, text: Column, words: Column, known: Column | None = None):
        self.text, self.words, self.known = text, words, known

    def __getitem__(self, measure: str) -> Column:
        return MEASURES[measure](self) if self.known is None else self.known[measure]


def _lines(text: Column) -> Column:
    """Lines with a word."""
    return F.filter(F.split(_text(text), "\n", -1), lambda line: F.btrim(line, F.lit(SPACE_CHARS)) != "")


def _n_words(doc: Doc) -> Column:
    return F.size(doc.words).cast("bigint")


def _word_chars(doc: Doc) -> Column:
    return F.length(F.array_join(doc.words, "")).cast("bigint")


def _n_symbols(doc: Doc) -> Column:
    return F.regexp_count(_text(doc.text), F.lit(f"[{SYMBOL_CHARS}]")).cast("bigint")


def _n_dup_lines(doc: Doc) -> Column:
    return let(_lines(doc.text), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint"))


def _covered(hashes: Column) -> Column:
    """Words covered by windows that occur twice, from the hash of every window."""
    size = F.size(hashes)
    placed = F.sort_array(F.zip_with(hashes, F.sequence(F.lit(0), size - 1), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def positions(s: Column) -> Column:
        # neighbours in hash order with the same hash are both repeats
        pairs = F.zip_with(
            s,
            F.slice(s, 2, F.size(s)),
            lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")),
        )
        return F.sort_array(F.array_distinct(F.flatten(pairs)))

    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))
    step = lambda acc, p: F.struct(
        (p + REPEAT_WINDOW).alias("end"),
        (acc["total"] + p + REPEAT_WINDOW - F.greatest(p, acc["end"])).alias("total"),
    )
    return F.aggregate(let(placed, positions), start, step, lambda acc: acc["total"].cast("bigint"))


def _n_repeat_words(doc: Doc) -> Column:
    """Words in windows of 8 words found twice or more (by 64-bit hash of the
    words' 64-bit hashes)."""
    none = F.lit(0).cast("bigint")

    def windows(h: Column) -> Column:
        whole = F.slice(h, 1, F.size(h) - (REPEAT_WINDOW - 1))
        return F.transform(whole, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, REPEAT_WINDOW)]))

    def of_windows(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) < F.size(h), _covered(h)).otherwise(none)

    hashes = F.transform(doc.words, lambda w: F.xxhash64(w))
    return F.when(F.size(doc.words) > REPEAT_WINDOW, let(let(hashes, windows), of_windows)).otherwise(none)


MEASURES: dict[str, Callable[[Doc], Column]] = {
    "n_words": _n_words,
    "word_chars": _word_chars,
    "n_symbols": _n_symbols,
    "n_dup_lines": _n_dup_lines,
    "n_repeat_words": _n_repeat_words,
}


@dataclass(frozen=True)
class Rule:
    """``rejects`` maps a document to a boolean column, never null."""

    name: str
    rejects: Callable[[Doc], Column]


def _word_length(doc: Doc) -> Column:
    return let(
        F.struct(doc["word_chars"].alias("c"), doc["n_words"].alias("n")), lambda x: (x["c"] < 2 * x["n"]) | (x["c"] > 15 * x["n"])
    )


def _shouts(doc: Doc) -> Column:
    """More capital than small letters (A-Z, a-z). With u capitals, u small
    letters near the beginning settle it; the whole text is counted otherwise."""
    t = _text(doc.text)

    def small(part: Column) -> Column:
        return F.length(F.regexp_replace(part, "[^a-z]+", ""))

    def of_capitals(u: Column) -> Column:
        return (u > 0) & (u > small(F.substring(t, F.lit(1), 4 * u + 100))) & (u > small(t))

    return let(F.regexp_count(t, F.lit("[A-Z]")), of_capitals)


def _stutters(doc: Doc) -> Column:
    """More than three in ten words equal the word before them."""
    w = doc.words
    same = F.filter(w, lambda x, i: (i > 0) & (x == F.get(w, i - 1)))
    return 10 * F.size(same) > 3 * F.size(w)


# Thresholds: documents of ordinary prose are far from all of them.
SHORT = Rule("short", lambda d: d["n_words"] < 20)
REPEATS = Rule("repeats", lambda d: 100 * d["n_repeat_words"] > 30 * d["n_words"])
SYMBOLS = Rule("symbols", lambda d: 100 * d["n_symbols"] > 10 * d["n_words"])
DUP_LINES = Rule("dup_lines", lambda d: 100 * d["n_dup_lines"] > 50 * F.size(_lines(d.text)))
WORD_LENGTH = Rule("word_length", _word_length)
SHOUTING = Rule("shouting", _shouts)
STUTTER = Rule("stutter", _stutters)
BASE_RULES = (SHORT, REPEATS)
RULES = (*BASE_RULES, SYMBOLS, DUP_LINES, WORD_LENGTH, SHOUTING, STUTTER)


def _sampled(docs: DataFrame, sample_rows: int) -> DataFrame:
    """About ``sample_rows`` rows from everywhere in the table, or all of it."""
    rows = docs.count()
    return docs if rows <= sample_rows else docs.sample(fraction=sample_rows / rows, seed=17)


def _rejected(text: Column, rule: Rule) -> Column:
    return let(words(text), lambda w: rule.rejects(Doc(text, w)))


def order_rules(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejections per second on a sample of about ``sample_rows``
    rows; each is timed ``TIMED_RUNS`` times, the first of them to warm it up."""
    sample = _sampled(docs.select(F.col(text_col).alias("t")), sample_rows).persist()
    try:
        rows = sample.count()

        def seconds(rejects: Column) -> tuple[float, int]:
            took = []
            for _ in range(TIMED_RUNS):
                began = time.perf_counter()
                hits = sample.agg(F.count_if(rejects)).first()[0]
                took.append(time.perf_counter() - began)
            return min(took), hits

        if not rows:
            return list(rules)
        empty, _ = seconds(F.length("t") < 0)
        found = []
        for rule in rules:
            took, hits = seconds(_rejected(F.col("t"), rule))
            found.append((hits / rows / max(took - empty, 1e-3), rule))
    finally:
        sample.unpersist()
    return [rule for _, rule in sorted(found, key=lambda x: (-x[0], x[1].name))]


def failed_rule(doc: Doc, ordered: Sequence[Rule]) -> Column:
    """Name of the first rule that rejects the document, else null."""
    out = F.when(ordered[0].rejects(doc), F.lit(ordered[0].name))
    for rule in ordered[1:]:
        out = out.when(rule.rejects(doc), F.lit(rule.name))
    return out


def judge(
    docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS, measured: bool = False
) -> DataFrame:
    """``docs`` with ``failed_rule`` (null: kept), by the ordered cascade, and
    with all measures as columns if they are asked for (an input column of the
    same name gives way)."""
    ordered = order_rules(docs, text_col, rules, sample_rows)
    text = F.col(text_col)
    if not measured:
        return docs.withColumn("failed_rule", let(words(text), lambda w: failed_rule(Doc(text, w), ordered)))

    def of_words(w: Column) -> Column:
        measures = F.struct(*[measure(Doc(text, w)).alias(name) for name, measure in MEASURES.items()])
        return let(measures, lambda m: F.struct(m.alias("m"), failed_rule(Doc(text, w, m), ordered).alias("failed_rule")))

    judged = docs.select(F.struct(*docs.columns).alias("row"), let(words(text), of_words).alias("found"))
    results = {"failed_rule": F.col("found.failed_rule"), **{name: F.col(f"found.m.{name}") for name in MEASURES}}
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in results]
    return judged.select(*kept, *[value.alias(name) for name, value in results.items()])


def keep_good(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows that no rule rejects, with the columns of ``docs``."""
    ordered = order_rules(docs, text_col, rules, sample_rows)
    text = F.col(text_col)
    return docs.filter(let(words(text), lambda w: failed_rule(Doc(text, w), ordered)).isNull())
