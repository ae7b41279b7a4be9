"""Text queries over the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideglass.catalog.registry import query
from tideglass.catalog.views import ABSTRACTS_SQL, abstracts, table
from tideglass.functions.words import ENGLISH_STOP_WORDS
from tideglass.functions.words import tokens as words_of
from tideglass.operators import dedup, lookups, wordstats

_STOP_SQL = ", ".join(f"'{word}'" for word in ENGLISH_STOP_WORDS)

WORDS_SQL = rf"""
pieces AS (
  SELECT doc_id, label, rtrim(unnest(string_split_regex(
    regexp_replace(lower(text), '(n''t|''s|''re|''ve|''ll|''d|''m)\b', ' ', 'g'),
    '[\s\pZ,;:?!()\[\]{{}}<>"“”„‘’«»`@#$%&*]+|--|\.{{2,}}')), '.''') AS piece
  FROM abstracts
),
words AS (
  SELECT doc_id, label, CASE piece WHEN 'cannot' THEN 'can' WHEN 'gimme' THEN 'gim'
    WHEN 'gonna' THEN 'gon' WHEN 'gotta' THEN 'got' WHEN 'lemme' THEN 'lem'
    WHEN 'wanna' THEN 'wan' ELSE piece END AS word
  FROM pieces
),
kept AS (
  SELECT doc_id, label, word FROM words
  WHERE length(word) >= 3 AND regexp_full_match(word, '\pL+') AND word NOT IN ({_STOP_SQL})
)"""


@query(
    "label_counts",
    f"WITH {ABSTRACTS_SQL} SELECT label, count(*) AS count FROM abstracts GROUP BY label",
)
def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.label_counts(abstracts(spark, sf_dir))


@query("distinct_labels", f"WITH {ABSTRACTS_SQL} SELECT DISTINCT label FROM abstracts")
def distinct_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.distinct_values(abstracts(spark, sf_dir), "label")


@query("distinct_langs", "SELECT DISTINCT lang FROM documents")
def distinct_langs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.distinct_values(table(spark, sf_dir, "documents"), "lang")


@query(
    "word_counts",
    f"""WITH {ABSTRACTS_SQL}, {WORDS_SQL}
    SELECT word, count(*) AS count FROM kept GROUP BY word""",
)
def word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordstats.word_counts(abstracts(spark, sf_dir))


@query(
    "word_counts_by_label",
    f"""WITH {ABSTRACTS_SQL}, {WORDS_SQL}
    SELECT label, word, count(*) AS count FROM kept GROUP BY label, word""",
)
def word_counts_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordstats.word_counts(abstracts(spark, sf_dir), by="label")


@query(
    "top_words",
    f"""WITH {ABSTRACTS_SQL}, {WORDS_SQL}
    SELECT word, count(*) AS count FROM kept WHERE label = 'economy' GROUP BY word
    ORDER BY count DESC, word LIMIT 20""",
)
def top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = lookups.lookup(abstracts(spark, sf_dir), "label", "economy")
    return wordstats.top_words(chosen)


@query(
    "top_words_by_label",
    f"""WITH {ABSTRACTS_SQL}, {WORDS_SQL},
    counts AS (SELECT label, word, count(*) AS count FROM kept GROUP BY label, word)
    SELECT label, word, count FROM counts
    QUALIFY row_number() OVER (PARTITION BY label ORDER BY count DESC, word) <= 20""",
)
def top_words_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordstats.top_words(abstracts(spark, sf_dir), by="label")


@query(
    "tokens",
    f"""WITH {ABSTRACTS_SQL}, {WORDS_SQL}
    SELECT doc_id, count(word) AS n_words FROM abstracts LEFT JOIN kept USING (doc_id)
    GROUP BY doc_id""",
)
def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rows.select("doc_id", F.size(words_of(F.col("text"))).cast("bigint").alias("n_words"))


@query(
    "sample_paragraph",
    f"""WITH {ABSTRACTS_SQL}, first_texts AS (
      SELECT label, doc_id, text FROM abstracts
      QUALIFY row_number() OVER (PARTITION BY label ORDER BY doc_id) <= 5)
    SELECT label, string_agg(text, ' ' ORDER BY doc_id) AS paragraph
    FROM first_texts GROUP BY label""",
)
def sample_paragraph(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = abstracts(spark, sf_dir, ("doc_id",))
    return wordstats.sample_paragraph(rows, order_by=["doc_id"], by="label")
