"""The numbered queries: each operator over its whole table, with the digests asked for."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideglass.llm import (
    bloom_lm,
    decontamination,
    hamming_index,
    hard_negatives,
    line_quality,
    near_duplicates,
    packing,
    periodic_runs,
    pii,
    secrets,
    token_counts,
    toxicity,
    url_filter,
)
from tideglass.llm.common import read_table, remainder, workers_import_this

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str):
    def register(function):
        @functools.wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            workers_import_this(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        return run

    return register


@query("op3_best_two_fit_packing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    cut = packing.pieces(documents, public_tokenizers.path("byte_bpe_50k.json"), 1024, 2)
    return packing.pack(cut, 1024)


@query("op10_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return token_counts.token_counts(documents, public_tokenizers.path("piece_bpe_32k.model"), 4096)


#: Tokens of the SQL twins: A-Z lower-cased, by the two word classes of the queries.
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALPHANUMERIC_WORDS = rf"regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL["op9_suffix_array_decontamination"] = f"""
WITH d AS (SELECT doc_id, {ALPHANUMERIC_WORDS} AS w FROM documents),
b AS (SELECT item_id, {ALPHANUMERIC_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (
    SELECT item_id, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i, w
    FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM win),
sizes AS (SELECT DISTINCT k FROM windows),
pos AS (
    SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g FROM (
        SELECT doc_id, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)),
found AS (SELECT doc_id, item_id, i, p.k FROM pos p JOIN windows USING (k, g)),
hit AS (
    SELECT doc_id, count(DISTINCT j) AS n_hit FROM (
        SELECT doc_id, unnest(range(i, i + k)) AS j FROM (SELECT DISTINCT doc_id, i, k FROM found))
    GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (
        SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op9_suffix_array_decontamination")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_leaks(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), 10
    )
    covered = F.aggregate("hits", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        covered.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


SPACED_WORDS = rf"regexp_extract_all({LOWERED}, '[^\x20\x09-\x0D]+')"

SQL["op5_minhash_near_duplicates"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, {SPACED_WORDS} AS w FROM documents),
s AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS g
    FROM d),
g AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s),
common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) AS na, any_value(y.n) AS nb, count(*) AS shared
    FROM g x JOIN g y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM common WHERE 100 * shared >= 75 * (na + nb - shared)),
reach AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION SELECT r.doc_id, l.b FROM reach r JOIN link l ON r.other = l.a),
least_id AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM s JOIN least_id USING (doc_id)
"""


@query("op5_minhash_near_duplicates")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(read_table(spark, sf_dir, "documents"), percent=75)


@query("op8_recursive_secret_scan")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.secret_spans(documents)
    base = F.filter("secrets", lambda s: s["base"])

    def number(kind: str):
        return F.size(F.filter("secrets", lambda s: s["base"] & (s["kind"] == kind))).cast("long")

    def joined(spans):
        parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(parts, ",")

    return found.select(
        "doc_id",
        number("assign").alias("n_assign"),
        number("access").alias("n_access"),
        number("hex").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined("secrets").alias("spans"),
    )


#: The rules of the query.
RULES = [
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
]


@query("op4_redirect_equivalence")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read_table(spark, sf_dir, "pages"), RULES)


def held_out(modulus: int, rest: int):
    """Whether a row's id is in the held-out fold; an id of null is not."""
    return F.coalesce(remainder(F.col("doc_id"), modulus) == rest, F.lit(False))


@query("op6_crf_line_quality")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = line_quality.score_quality(
        read_table(spark, sf_dir, "documents"),
        read_table(spark, sf_dir, "labels"),
        train=~held_out(5, 0),
        threshold=0.3,
    )
    return scored.select("doc_id", held_out(5, 0).alias("held_out"), "score", "predicted")


@query("op7_nonnegative_pu_toxicity")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_toxicity(
        read_table(spark, sf_dir, "documents"),
        read_table(spark, sf_dir, "labels"),
        train=~held_out(5, 0),
        threshold=0.5,
    )
    return scored.select("doc_id", held_out(5, 0).alias("held_out"), "score", "predicted")


@query("op2_log_frequency_bloom_lm")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = bloom_lm.score(read_table(spark, sf_dir, "documents"), train=~held_out(7, 2))
    return scored.select(
        "doc_id",
        held_out(7, 2).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


@query("op1_multi_index_hashing")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return hamming_index.nearest(vectors, F.col("vec_id") % 20 == 0, k=20)


SQL["op12_bond_hard_negatives"] = """
WITH valid AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike,
        CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM valid a JOIN valid b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, positive_score, other_id AS negative_id, score AS negative_score,
    CAST(row_number() OVER (
        PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


@query("op12_bond_hard_negatives")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


@query("op11_weak_supervision_pii")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.pii_spans(documents)
    base = F.filter("pii", lambda s: s["base"])

    def number(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(parts, ",")

    return found.select(
        "doc_id",
        *[number(kind) for kind in pii.KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined("pii").alias("spans"),
    )


#: crc32 of a decimal number, in SQL that has no such function: bit by bit, -1 standing for a step.
_CRC32 = """xor(4294967295, list_reduce(
    flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
        lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x)
        ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END, CAST(4294967295 AS BIGINT)))"""
#: Hashes of windows of 1, 2, 4, ... words, each from two of the one before, and where a block of so
#: many words returns after that distance at least: candidates for periods.
_WINDOW_SIZES = [1 << k for k in range(18)]
_WINDOWS = ",\n".join(
    ["h1 AS (SELECT rid, i, n, hash(word) AS h FROM words)"]
    + [
        f"""h{size} AS (SELECT * FROM (SELECT rid, i, n, hash(h, lead(h, {size // 2}) OVER o) AS h,
        lead(i, {size // 2}) OVER o IS NOT NULL AS whole FROM h{size // 2} WHERE n >= {3 * min(size, 8)}
        WINDOW o AS (PARTITION BY rid ORDER BY i)) WHERE whole)"""
        for size in _WINDOW_SIZES[1:]
    ]
)
_RETURNS = "\nUNION\n".join(
    f"""SELECT a.rid, b.i - a.i AS q FROM h{size} a JOIN h{size} b USING (rid, h)
    WHERE a.i % {size} = 0 AND b.i - a.i BETWEEN {1 if size == 8 else size} AND {2 * size - 1}"""
    for size in _WINDOW_SIZES
    if size >= 8
)

SQL["op13_dyadic_square_runs"] = rf"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, {_CRC32} AS crc,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
drawn AS (
    SELECT rid, doc_id, w, len(w) AS n, crc % 10 = 0 AND len(w) > 0 AS made,
        (crc // 10) % greatest(len(w), 1) AS a, crc // 10 AS g FROM d),
placed AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM drawn),
texts AS (
    SELECT rid, doc_id, n, CASE WHEN made THEN [w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]
        FOR i IN range(n)] ELSE w END AS w FROM placed),
words AS (SELECT rid, n, unnest(range(n)) AS i, unnest(w) AS word FROM texts),
{_WINDOWS},
returns AS ({_RETURNS}),
alike AS (
    SELECT rid, q, unnest(list_filter(range(n - q), lambda i: w[i + 1] = w[i + q + 1])) AS i
    FROM returns JOIN texts USING (rid)),
islands AS (SELECT rid, q, i, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS g FROM alike),
stretches AS (
    SELECT rid, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY rid, q, g
    HAVING count(*) + q >= greatest(24, 3 * q)),
runs AS (
    SELECT rid, start, length, min(q) AS period FROM stretches GROUP BY rid, start, length),
lists AS (
    SELECT rid, count(*) AS n_runs,
        string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs
    FROM runs GROUP BY rid),
best AS (
    SELECT * FROM runs QUALIFY row_number() OVER (
        PARTITION BY rid ORDER BY length / period DESC, start, period) = 1),
dropped AS (SELECT DISTINCT rid, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
    SELECT rid, string_agg(word, ' ' ORDER BY i) AS collapsed
    FROM words ANTI JOIN dropped USING (rid, i) GROUP BY rid)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, start, length, period,
    CAST((1000 * length) // period AS BIGINT) AS exponent_milli,
    sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM texts LEFT JOIN lists USING (rid) LEFT JOIN best USING (rid) LEFT JOIN kept USING (rid)
"""


def _with_made_repeats(documents: DataFrame) -> DataFrame:
    """``documents`` where a tenth of the texts goes on in a period from some word on."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = F.coalesce(crc % 10 == 0, F.lit(False))
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    n = F.size("w").cast("long")
    drawn = documents.select("doc_id", "text", F.floor(crc / 10).alias("g"), F.when(chosen, words).alias("w"))
    drawn = drawn.withColumn("a", F.when(n > 0, F.col("g") % n))
    drawn = drawn.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))
    a, p = F.col("a").cast("int"), F.col("p").cast("int")
    times = F.ceil((n - a) / p).cast("int")
    again = F.flatten(F.array_repeat(F.slice("w", a + 1, p), times))
    repeated = F.slice(F.concat(F.slice("w", F.lit(1), a), again), F.lit(1), F.size("w"))
    made = F.when(F.size("w") > 0, F.array_join(repeated, " "))
    return drawn.select("doc_id", F.coalesce(made, "text").alias("text"))


@query("op13_dyadic_square_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _with_made_repeats(read_table(spark, sf_dir, "documents"))
    found = periodic_runs.periodic_runs(documents).select("doc_id", "periodic.*")
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    nothing = F.lit(None).cast("struct<start:bigint, length:bigint, period:bigint>")
    # Runs are in order, so of equal exponents the first stays.
    best = F.reduce(
        "runs",
        nothing,
        lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b),
    )
    listed = found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best.alias("best"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    milli = F.floor(1000 * F.col("best.length") / F.col("best.period"))
    return listed.select(
        "doc_id", "n_runs", "best.*", milli.alias("exponent_milli"), "runs_sha256", "collapsed_sha256"
    )


_HOST = f"""translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""
_PATH = "regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
_NODE = f"""CASE WHEN contains(url, '://')
    THEN 'http://' || {_HOST} || regexp_extract(url, '(?s)^.*?://[^/?#]*([^#]*)', 1) END"""


def _rule_case(value) -> str:
    """SQL for what ``value`` says of the longest rule that fits ``host`` and ``path``."""
    cases = [
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') "
        f"THEN '{value(r)}'"
        for r in sorted(RULES, key=lambda r: -len(r.name))
    ]
    return f"CASE {' '.join(cases)} END"


#: Patterns of the SQL twin; single quotes are doubled, as SQL wants them.
_LINK_MARK = r"""(?is)\brel\s*=\s*["'']?[^"''>]*\bcanonical\b"""
_LINK_PLACE = r"""(?is)\bhref\s*=\s*["'']?\s*([^"''\s>]+)"""
_META_MARK = r"""(?is)\bhttp-equiv\s*=\s*["'']?refresh\b"""
_META_PLACE = r"""(?is)\bcontent\s*=.*?\burl\s*=\s*["'']?\s*([^"''\s>]+)"""


def _tags(tag: str, mark: str, place: str) -> str:
    return rf"""SELECT url, regexp_extract(t, '{place}', 1) AS target
    FROM (SELECT url, unnest(regexp_extract_all(coalesce(html, ''), '(?is)<{tag}\b[^>]*>')) AS t
      FROM pages)
    WHERE regexp_matches(t, '{mark}')"""


SQL["op4_redirect_equivalence"] = f"""
WITH RECURSIVE tags AS (
    {_tags("link", _LINK_MARK, _LINK_PLACE)}
    UNION ALL
    {_tags("meta", _META_MARK, _META_PLACE)}),
seen AS (
    SELECT url AS source, {_NODE} AS node, trim(replace(target, '&amp;', '&')) AS t,
        regexp_extract(url, '(?s)^(.*?)://', 1) AS scheme,
        regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) AS site, {_PATH} AS path,
        coalesce(nullif(regexp_extract({_PATH}, '(?s)^(.*/)', 1), ''), '/') AS folder
    FROM tags WHERE contains(url, '://') AND target <> ''),
targets AS (
    SELECT node, CASE WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t
        WHEN starts_with(t, '//') THEN scheme || ':' || t WHEN starts_with(t, '/') THEN site || t
        WHEN starts_with(t, '?') THEN site || path || t WHEN starts_with(t, '#') THEN source
        WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL ELSE site || folder || t END AS url
    FROM seen),
pairs AS (SELECT node AS a, {_NODE} AS b FROM targets),
links AS (
    SELECT a, b FROM pairs WHERE a <> b UNION SELECT b, a FROM pairs WHERE a <> b),
reach AS (
    SELECT a AS node, a AS other FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a),
aliases AS (SELECT node, min(other) AS alias FROM reach GROUP BY node),
judged AS (
    SELECT alias, {_rule_case(lambda r: r.verdict)} AS own
    FROM (SELECT alias, {_HOST} AS host, {_PATH} AS path FROM (SELECT alias, node AS url FROM aliases))),
decided AS (
    SELECT alias, CASE WHEN bool_or(own = 'allow') THEN 'allow' WHEN bool_or(own = 'block') THEN 'block' END AS shared
    FROM judged GROUP BY alias),
p AS (SELECT page_id, {_NODE} AS node, {_HOST} AS host, {_PATH} AS path FROM pages)
SELECT page_id, host, path, {_rule_case(lambda r: r.name)} AS rule,
    coalesce({_rule_case(lambda r: r.verdict)}, shared, 'allow') AS verdict, alias
FROM p LEFT JOIN aliases USING (node) LEFT JOIN decided USING (alias)
"""
