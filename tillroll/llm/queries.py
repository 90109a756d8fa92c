"""Registered queries of the operators, and their DuckDB SQL where there is one.

Each query applies its operator with production parameters to its whole table
and derives the digest columns from the operator's own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import chat_format, chat_trie, classifier, decontam, licenses, near_dedup, packing, phrase_dedup, quality_rules, secret_scan, suffix_dedup, url_rules, vector_codes
from tillroll.session import materialize


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file on this machine and every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _hex_sha256(col) -> F.Column:
    return F.sha2(col.cast("binary"), 256)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = quality_rules.judge(_table(spark, sf_dir, "documents").select("doc_id", "text"), measured=True)
    base_failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return measured.select(
        "doc_id",
        *quality_rules.MEASURES,
        base_failed.alias("base_failed"),
        (~base_failed & F.col("failed_rule").isNull()).alias("kept"),
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontam.find_leaks(docs, _table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        _hex_sha256(F.array_join("items", ",")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = licenses.scan_licenses(docs)
    return out.select("doc_id", F.explode("licenses").alias("l")).select(
        "doc_id", "l.license", "l.start", "l.stop", "l.differing_words", F.round("l.saving", 6).alias("saving")
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = suffix_dedup.remove_repeated_bytes(docs)
    return out.select(
        "doc_id",
        F.col("n_symbols").alias("n_bytes"),
        "n_removed",
        F.size("removed").cast("long").alias("n_spans"),
        _hex_sha256(F.col("kept")).alias("kept_sha256"),
    )


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    net = classifier.train(docs, _table(spark, sf_dir, "labels"))
    return classifier.score_documents(docs, net).select(
        "doc_id",
        classifier.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


CONTROL_CHAT = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(CONTROL_CHAT, turns.schema)
    path = tokenizer_path(chat_format.TOKENIZER_FILE)
    back = chat_format.read_back(chat_format.format_chats(turns.unionByName(extra), path), path)
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        _hex_sha256(told).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        _hex_sha256(F.col("loss_text")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


URL_RULES = (
    url_rules.UrlRule("org/", True),
    url_rules.UrlRule("example.org/es/", False),
    url_rules.UrlRule("example.org/en/1", False),
    url_rules.UrlRule("com/fr/", True),
    url_rules.UrlRule("com/de/", False),
)


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    out = url_rules.judge_urls(pages, URL_RULES)
    return out.select(
        "page_id", "host", "path", "rule", F.when(F.col("allowed"), "allow").otherwise("block").alias("verdict")
    )


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.link_documents(_table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = phrase_dedup.remove_repeated_passages(docs)
    return out.select(
        "doc_id", F.col("n_symbols").alias("n_words"), "n_removed", _hex_sha256(F.col("kept")).alias("kept_sha256")
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = packing.pack_documents(docs, tokenizer_path(packing.TOKENIZER_FILE))
    return out.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    books = vector_codes.train(vectors)
    coded = materialize(vector_codes.encode(vectors, books), "vector-codes")
    return vector_codes.with_label_error(coded).select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256() if books else None).alias("codebooks_sha256")
    )


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_trie.prefix_trie(_table(spark, sf_dir, "conversations")).drop("node")


def op13_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan_secrets(docs, secret_scan.train(docs))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")

    def counted(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("secrets", lambda s: s["kind"].isin(*secret_scan.BASE_KINDS))
    return found.select(
        "doc_id",
        *[counted(kind) for kind in secret_scan.BASE_KINDS],
        _hex_sha256(listed(base)).alias("base_sha256"),
        listed(F.col("secrets")).alias("spans"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_decontamination": op2_decontamination,
    "op3_license_scans": op3_license_scans,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_url_filters": op7_url_filters,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_packing": op10_packing,
    "op11_vector_codes": op11_vector_codes,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_secret_scans": op13_secret_scans,
}

# The word classes in SQL.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWERED = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"
_ALNUM_WORDS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {_WORDS} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
p AS (SELECT r, unnest(range(1, len(w) - 6)) AS i, w FROM d WHERE len(w) >= 8),
win AS (SELECT r, i, array_to_string(list_slice(w, i, i + 7), ' ') AS s FROM p),
dup AS (SELECT r, s FROM win GROUP BY r, s HAVING count(*) > 1),
hit AS (SELECT r, list(i) AS starts FROM win SEMI JOIN dup USING (r, s) GROUP BY r),
rep AS (SELECT r, len(list_distinct(flatten(list_transform(starts, lambda i: range(i, i + 8))))) AS n FROM hit),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines,
    len(regexp_extract_all(t, '[A-Z]')) > len(regexp_extract_all(t, '[a-z]')) AS shouts,
    10 * len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) > 3 * len(w) AS stutters
  FROM d LEFT JOIN rep USING (r)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 50 * n_lines
       OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR shouts OR stutters) AS kept
FROM b""",
    "op2_decontamination": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_ALNUM_WORDS} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_ALNUM_WORDS} AS w FROM benchmark),
q AS (SELECT DISTINCT item, least(len(w), 10) AS size,
    unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2), lambda i: array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' '))) AS s
  FROM b WHERE len(w) > 0),
win AS (SELECT r, i, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS s
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM q) WHERE len(w) >= size)),
hit AS (SELECT r, i, win.size, item FROM win JOIN q ON win.s = q.s AND win.size = q.size),
n AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS j FROM hit) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN it USING (r)""",
    # Markers: 3 characters of <s>, 13 around a user turn, 15 around a system
    # turn, 10 around an assistant turn; two more characters for each control
    # string and one for each escape character in a text.
    "op6_chat_formatting": rf"""
WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
m AS (SELECT *, row_number() OVER () AS r, CASE role WHEN 'user' THEN 13 WHEN 'system' THEN 15 WHEN 'assistant' THEN 10 END
    + length(text) + length(text) - length(replace(text, chr(27), ''))
    + 2 * len(regexp_extract_all(text, '<<SYS>>|<</SYS>>|</?s>|\[/?INST\]|\[/?ROLE\]|\[ASST\]')) AS shown FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(shown) AS BIGINT) AS formatted_chars
FROM m GROUP BY conv_id, CASE WHEN conv_id IS NULL THEN r END""",
    "op7_url_filters": rf"""
WITH u AS (SELECT row_number() OVER () AS r, page_id,
    CASE WHEN contains(url, '://') THEN substring(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT r, page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_UPPER.lower()}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(rule, h, p, verdict) AS (VALUES ('org/', 'org', '', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
  ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'), ('com/de/', 'com', '/de/', 'block')),
best AS (SELECT r, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, rules.p) GROUP BY r)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN best USING (r)""",
    "op8_minhash_near_dedup": rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - least(len(w), 5) + 2),
    lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) AS x FROM d WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM c JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id WHERE 100 * k >= 75 * (na.n + nb.n - k)),
reach AS (SELECT doc_id, doc_id AS to_id FROM d UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.to_id = l.a),
comp AS (SELECT doc_id, min(to_id) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN comp USING (doc_id)""",
    "op9_substring_dedup": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
p AS (SELECT r, unnest(range(1, len(w) - 33)) AS i, w FROM d WHERE len(w) >= 35),
win AS (SELECT r, i, array_to_string(list_slice(w, i, i + 34), ' ') AS s FROM p),
dup AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
hit AS (SELECT r, list(i) AS starts FROM win SEMI JOIN dup USING (s) GROUP BY r),
cov AS (SELECT DISTINCT r, unnest(list_distinct(flatten(list_transform(starts, lambda i: range(i, i + 35))))) AS j FROM hit),
gone AS (SELECT r, list(j) AS js FROM cov GROUP BY r),
pos AS (SELECT d.r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY j) AS t FROM pos ANTI JOIN cov USING (r, j) GROUP BY r)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(js), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (r) LEFT JOIN kept USING (r)""",
}


def _codebook_sql(rounds: int) -> str:
    """Codebooks c0, c1, ... and the assignments a0, a1, ... made with them."""
    steps = []
    for n in range(rounds + 1):
        steps.append(
            f"""d{n} AS (SELECT x.r, x.p, c.i, list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
  FROM parts x JOIN c{n} c USING (p)),
a{n} AS (SELECT r, p, CAST(min(d) AS BIGINT) AS d, arg_min(i, d * 64 + i) AS i FROM d{n} GROUP BY r, p)"""
        )
        if n < rounds:
            steps.append(
                f"""s{n} AS (SELECT p, i, k, CAST(sum(v[k]) AS BIGINT) AS s, count(*) AS n
  FROM (SELECT a.p, a.i, x.v, unnest(range(1, len(x.v) + 1)) AS k FROM a{n} a JOIN parts x USING (r, p)) GROUP BY p, i, k),
m{n} AS (SELECT p, i, list((s - ((s % n) + n) % n) // n ORDER BY k) AS v FROM s{n} GROUP BY p, i),
c{n + 1} AS (SELECT p, i, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN m{n} m USING (p, i))"""
            )
    return ",\n".join(steps)


ORACLE_SQL["op11_vector_codes"] = f"""
WITH e AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT r, p, list_slice(v, p * (len(v) // 16) + 1, (p + 1) * (len(v) // 16)) AS v FROM e, (SELECT unnest(range(16)) AS p)),
c0 AS (SELECT p, r - 1 AS i, v FROM parts WHERE r <= 64),
{_codebook_sql(2)},
books AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, i)) AS codebooks_sha256 FROM c2),
coded AS (SELECT r, string_agg(lpad(lower(to_hex(i)), 2, '0'), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a2 GROUP BY r),
per_label AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM coded JOIN e USING (r) GROUP BY label)
SELECT e.vec_id, code, error, label_error, codebooks_sha256
FROM e JOIN coded USING (r) JOIN per_label ON e.label IS NOT DISTINCT FROM per_label.label, books"""


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_ASSIGN = "(" + "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key")) + ")"
_ASSIGN += r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""  # quotes doubled, as in an SQL string
_TOKEN = r"[A-Za-z0-9+/_\-\x{80}-\x{10FFFF}]{16,}"


def _spans_sql(number: int, kind: str, pattern: str, value: str) -> str:
    """Matches of a pattern with their places: the lengths of the stretches
    between matches and of the matches before add up. ``value`` is the length
    of the part at the end that spells the secret."""
    return f"""
  SELECT r, {number} AS k, '{kind}' AS kind, found[i] AS s, start, start + length(found[i]) AS stop, {value} AS size
  FROM (SELECT r, found, values, i, CAST(list_sum(list_transform(gaps[:i], lambda x: length(x)))
      + coalesce(list_sum(list_transform(found[:i - 1], lambda x: length(x))), 0) AS BIGINT) AS start
    FROM (SELECT r, string_split_regex(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}') AS found,
        regexp_extract_all(t, '{pattern}', {2 if kind == "assign" else 0}) AS values,
        unnest(range(1, len(regexp_extract_all(t, '{pattern}')) + 1)) AS i
      FROM d))"""


def _chains_sql(n: str, ordinary: str) -> str:
    """Chains of characters: transitions of both classes, with 16 more dealt
    out by the frequency of single characters (smoothed by one half), their
    log ratios in units of 2**-20, and the tokens' scores."""
    chance = [
        f"(coalesce(n{y}, 0) + 16 * (coalesce(c{y}, 0) + 0.5::DOUBLE) / (a{y} + 33)) / (coalesce(t{y}, 0) + 16)" for y in (0, 1)
    ]
    return f"""samples{n} AS (SELECT 1 AS y, s FROM runs UNION ALL SELECT 0, s FROM {ordinary}),
n{n} AS (SELECT b, c, count(*) FILTER (y = 0) AS n0, count(*) FILTER (y = 1) AS n1
  FROM (SELECT y, CASE WHEN i = 1 THEN '' ELSE s[i - 1] END AS b, s[i] AS c
    FROM (SELECT y, s, unnest(range(1, length(s) + 1)) AS i FROM samples{n})) GROUP BY b, c),
before{n} AS (SELECT b, sum(n0) AS t0, sum(n1) AS t1 FROM n{n} GROUP BY b),
single{n} AS (SELECT c, sum(n0) AS c0, sum(n1) AS c1 FROM n{n} GROUP BY c),
every{n} AS (SELECT coalesce(sum(n0), 0) AS a0, coalesce(sum(n1), 0) AS a1 FROM n{n}),
scored{n} AS (SELECT r, start, stop, any_value(s) AS s, sum(CAST(round((ln({chance[1]}) - ln({chance[0]})) * 1048576) AS BIGINT)) / 1048576 AS score
  FROM (SELECT r, start, stop, s, CASE WHEN i = 1 THEN '' ELSE s[i - 1] END AS b, s[i] AS c
    FROM (SELECT r, start, stop, s, unnest(range(1, length(s) + 1)) AS i FROM tokens))
  LEFT JOIN n{n} USING (b, c) LEFT JOIN before{n} USING (b) LEFT JOIN single{n} USING (c), every{n} GROUP BY r, start, stop)"""


ORACLE_SQL["op13_secret_scans"] = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
base AS (SELECT * FROM ({_spans_sql(0, "assign", _ASSIGN, "length(values[i])")}) WHERE size >= 12
  UNION ALL SELECT * FROM ({_spans_sql(1, "access", "AKIA[A-Z0-9]+", "length(found[i]) - 4")}) WHERE size >= 14
  UNION ALL SELECT * FROM ({_spans_sql(2, "hex", "[0-9a-f]{16,}", "length(found[i])")})),
tokens AS (SELECT r, start, stop, s FROM ({_spans_sql(3, "random", _TOKEN, "0")}) x
  WHERE NOT regexp_matches(s, '[^\x00-\x7F]')
    AND NOT EXISTS (SELECT 1 FROM base b WHERE b.r = x.r AND b.start < x.stop AND x.start < b.stop)),
spelt AS (SELECT DISTINCT r, p, substring(t, p + 1, 1) AS c
  FROM (SELECT r, unnest(range(stop - size, stop)) AS p FROM base) JOIN d USING (r)
  WHERE regexp_matches(substring(t, p + 1, 1), '[A-Za-z0-9+/_\-]')),
runs AS (SELECT r, g, string_agg(c, '' ORDER BY p) AS s FROM (SELECT *, p - row_number() OVER (PARTITION BY r ORDER BY p) AS g FROM spelt)
  GROUP BY r, g HAVING count(*) >= 12),
{_chains_sql("", "tokens")},
{_chains_sql("2", "(SELECT s FROM scored WHERE score <= 0)")},
odds AS (SELECT ln((count(*) FILTER (y = 0) + 1)::DOUBLE / (count(*) FILTER (y = 1) + 1)) AS least FROM samples2),
hits AS (SELECT r, k, kind, start, stop FROM base UNION ALL SELECT r, 3, 'random', start, stop FROM scored2, odds WHERE score > least),
told AS (SELECT r, count(*) FILTER (k = 0) AS a, count(*) FILTER (k = 1) AS b, count(*) FILTER (k = 2) AS c,
    string_agg(concat(kind, ':', start, ':', stop), ',' ORDER BY start, k) FILTER (k < 3) AS base,
    string_agg(concat(kind, ':', start, ':', stop), ',' ORDER BY start, k) AS spans FROM hits GROUP BY r)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN told USING (r)"""


# crc32 bit by bit: the register is the first element of the list, the text's
# bits follow, lowest first.
_CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
    lambda ch: list_transform(range(8), lambda i: CAST((ascii(ch) >> CAST(i AS INTEGER)) & 1 AS BIGINT))))),
    lambda crc, bit: xor(crc >> 1, 3988292384::BIGINT * (xor(crc, bit) & 1))), 4294967295::BIGINT)"""

ORACLE_SQL["op12_prefix_trie"] = rf"""
WITH RECURSIVE t AS (SELECT conv_id, concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')) AS told,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words, turn FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, told, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(told)) AS pos FROM t),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {_CRC32} % 4 AS h FROM (SELECT DISTINCT conv_id FROM t)),
again AS (SELECT c.conv_id, 0 AS own, pos, told, words FROM c JOIN o ON o.conv_id = c.base AND o.pos <= c.h
  UNION ALL SELECT c.conv_id, 1, pos, told, words FROM c JOIN o USING (conv_id) WHERE o.pos > c.h),
d AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY own, pos) AS depth FROM again),
p AS (SELECT conv_id, depth, words, sha256(string_agg(sha256(told), '' ) OVER (PARTITION BY conv_id ORDER BY depth)) AS key FROM d
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
q AS (SELECT *, lag(key) OVER (PARTITION BY conv_id ORDER BY depth) AS up, max(depth) OVER (PARTITION BY conv_id) AS size FROM p),
n AS (SELECT key, min(conv_id) AS conv_id, depth, any_value(up) AS up, count(*) AS n_convs, any_value(words) AS words,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (depth = size), '') AS ends
  FROM q GROUP BY key, depth),
kids AS (SELECT up AS key, count(*) AS n_children FROM n WHERE up IS NOT NULL GROUP BY up),
below AS (SELECT DISTINCT a.key, b.key AS under FROM p a JOIN p b ON a.conv_id = b.conv_id AND b.depth >= a.depth),
sums AS (SELECT below.key, count(*) FILTER (n_children IS NULL) AS n_leaves, CAST(sum((n_convs - 1) * words) AS BIGINT) AS saved_tokens
  FROM below JOIN n ON below.under = n.key LEFT JOIN kids ON below.under = kids.key GROUP BY below.key)
SELECT n.conv_id, n.depth, m.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens,
  sha256(n.ends) AS ends_sha256
FROM n LEFT JOIN n m ON n.up = m.key LEFT JOIN kids ON n.key = kids.key JOIN sums ON n.key = sums.key"""
