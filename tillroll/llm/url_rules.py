"""URL filters: allow and block rules by a sort-merge range join.

Hosts become canonical keys, their labels reversed and closed by a dot:
``m.example.org`` is ``org.example.m.``. A rule's host covers itself and its
subdomains, which are exactly the keys that begin with the rule's key, so every
rule is an interval ``[org.example., org.example/)`` (the slash follows the dot
in byte order). Such intervals nest or are apart.

A sweep over the sorted interval ends keeps the stack of active rules and
yields segments, each from one boundary to the next with its stack. Urls and
segments are then sorted together by key, and every url takes the segment that
starts last at or before it. Of the active rules those whose path begins the
url's path fit, and the longest rule wins.

Rows are dealt by a salt, not by host: every salt gets all segments (a few per
rule) and its share of the urls, so one host with a third of all rows is spread
evenly. The rules are a stated set, checked against ``max_rules``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MAX_RULES = 100_000
CHUNK = 64  # events swept from one empty stack


@dataclass(frozen=True)
class UrlRule:
    """``prefix`` is a host, a slash and the beginning of a path."""

    prefix: str
    allow: bool

    @property
    def host(self) -> str:
        return self.prefix.partition("/")[0].lower()

    @property
    def path(self) -> str:
        return "/" + self.prefix.partition("/")[2]


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.expr("substring(_url, locate('://', _url) + 3)")).otherwise(F.lit(""))


def split_url(pages: DataFrame, url_col: str) -> DataFrame:
    """``pages`` with ``_host`` and ``_path`` (both empty without ``://``)."""
    url = pages.withColumn("_url", F.coalesce(F.col(url_col).cast("string"), F.lit("")))
    rest = url.withColumn("_rest", _after_scheme(F.col("_url")))
    host = F.translate(F.regexp_extract("_rest", r"^([^/?#]*)", 1), _UPPER, _UPPER.lower())
    return rest.select(*pages.columns, host.alias("_host"), F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1).alias("_path"))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _sweep(chunk: Column) -> Column:
    """One chunk of events swept by itself: ``out`` has for every event how many
    intervals of before the chunk have closed by then (``pops``) and the stack
    of those opened in it; ``pops`` and ``stack`` are those of its end."""
    at = "pops:int,stack:array<int>"
    state = f"struct<{at},out:array<struct<start:string,{at}>>>"
    nothing = F.struct(F.lit(0).alias("pops"), F.array().alias("stack"), F.array().alias("out")).cast(state)

    def step(acc: Column, e: Column) -> Column:
        opens, some = e["opens"] == 1, F.size(acc["stack"]) > 0
        stack = (
            F.when(opens, F.concat(acc["stack"], F.array(e["id"])))
            .when(some, F.slice(acc["stack"], 1, F.size(acc["stack"]) - 1))
            .otherwise(acc["stack"])
        )
        pops = acc["pops"] + F.when(opens | some, F.lit(0)).otherwise(F.lit(1))
        return F.struct(pops, stack, F.concat(acc["out"], F.array(F.struct(e["key"].alias("start"), pops.alias("pops"), stack.alias("stack"))))).cast(state)

    return F.aggregate(chunk, nothing, step)


def _resumed(base: Column, part: Column) -> Column:
    """The whole stack, from the stack before a chunk and the chunk's own part."""
    return F.concat(F.slice(base, 1, F.size(base) - part["pops"]), part["stack"])


def segments(spark, rules: Sequence[UrlRule]) -> DataFrame:
    """``(start, active)``: boundaries in key order with the rules active from
    there on, by a stack over the sorted interval ends.

    The events are swept in chunks of ``CHUNK``, each from an empty stack, and
    the stacks at the chunks' ends then complete them, so that no array grows
    over all events while it is copied at each of them.
    """
    schema = "host string, path string, rule string, allow boolean"
    frame = spark.createDataFrame([(r.host, r.path, r.prefix, r.allow) for r in rules], schema).distinct()
    # A rule without a path reaches the whole host; an empty path equals "/".
    rule = F.struct(F.when(F.col("path") == "/", F.lit("")).otherwise(F.col("path")).alias("path"), "rule", "allow")
    by_host = (
        frame.groupBy(host_key(F.col("host")).alias("start"))
        .agg(F.sort_array(F.collect_list(rule)).alias("rules"))
        .select("start", F.concat(F.expr("substring(start, 1, length(start) - 1)"), F.lit("/")).alias("end"), "rules")
        .agg(F.collect_list(F.struct("start", "end", "rules")).alias("hosts"))
    )

    def ends(host: Column, i: Column) -> Column:
        # at one key intervals close before others open
        return F.array(
            F.struct(host["end"].alias("key"), F.lit(0).alias("opens"), i.alias("id")),
            F.struct(host["start"].alias("key"), F.lit(1).alias("opens"), i.alias("id")),
        )

    events = by_host.withColumn("events", F.sort_array(F.flatten(F.transform("hosts", ends))))
    numbers = F.expr(f"sequence(0, greatest(cast(size(events) as int) - 1, 0) div {CHUNK})")
    chunks = F.transform(numbers, lambda i: F.slice("events", (i * CHUNK + 1).cast("int"), CHUNK))
    swept = events.withColumn("chunks", F.transform(chunks, _sweep))
    stacks = "struct<stack:array<int>,before:array<array<int>>>"
    before = F.aggregate(
        "chunks",
        F.struct(F.array().alias("stack"), F.array().alias("before")).cast(stacks),
        lambda acc, c: F.struct(_resumed(acc["stack"], c), F.concat(acc["before"], F.array(acc["stack"]))).cast(stacks),
        lambda acc: acc["before"],
    )
    parts = swept.select("hosts", F.transform("chunks", lambda c: c["out"]).alias("out"), before.alias("before"))
    one = parts.select("hosts", "before", F.posexplode("out").alias("chunk", "out")).select(
        "hosts", "chunk", F.expr("before[chunk]").alias("before"), F.posexplode("out").alias("at", "s")
    )
    rules_of = F.transform(_resumed(F.col("before"), F.col("s")), lambda i: F.col("hosts")[i]["rules"])
    return one.select(
        (F.col("chunk") * CHUNK + F.col("at")).cast("int").alias("no"), F.col("s.start").alias("start"), F.flatten(rules_of).alias("active")
    )


def judge_urls(
    pages: DataFrame,
    rules: Sequence[UrlRule],
    url_col: str = "url",
    default_allow: bool = True,
    salts: int | None = None,
    max_rules: int = MAX_RULES,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (the rule's prefix, else null)
    and ``allowed`` (the rule's, else ``default_allow``).

    Null urls and urls without ``://`` have empty host and path, which no rule
    fits. Of equally long rules the greater prefix wins, and of one prefix with
    both verdicts the one that allows. Repeated rows are judged alike; columns of ``pages`` named like the
    results are replaced. An empty table or rule set is allowed.
    """
    if len(rules) > max_rules:
        raise ValueError(f"{len(rules)} rules exceed max_rules={max_rules}")
    spark = pages.sparkSession
    salts = salts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = F.struct(*[F.col(c) for c in pages.columns])
    urls = split_url(pages.select(own.alias("_page"), F.col(url_col).alias("_link")), "_link").select(
        "_page", "_host", "_path", host_key(F.col("_host")).alias("_key")
    )
    urls = urls.withColumn("_salt", F.pmod(F.xxhash64("_page", F.col("_path")), F.lit(salts)).cast("int"))
    marks = segments(spark, rules).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    both = urls.withColumn("_no", F.lit(2**31 - 1)).unionByName(
        marks.select("_salt", F.col("start").alias("_key"), F.col("no").alias("_no"), F.struct("active").alias("_segment")),
        allowMissingColumns=True,
    )
    # Boundaries of one key apply in sweep order, and before the urls of that key.
    sweep = Window.partitionBy("_salt").orderBy("_key", "_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    active = F.last("_segment", ignorenulls=True).over(sweep)
    judged = both.withColumn("_active", active).filter(F.col("_page").isNotNull())
    fits = F.filter(F.col("_active.active"), lambda r: F.startswith(F.col("_path"), r["path"]))
    ranked = F.transform(fits, lambda r: F.struct(F.length(r["rule"]).alias("n"), r["rule"].alias("rule"), r["allow"].alias("allow")))
    best = F.array_max(ranked)
    names = [c for c in pages.columns if c not in {"host", "path", "rule", "allowed"}]
    return judged.withColumn("_best", best).select(
        *[F.col("_page").getField(c).alias(c) for c in names],
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_best.rule").alias("rule"),
        F.coalesce(F.col("_best.allow"), F.lit(default_allow)).alias("allowed"),
    )
