"""Word frequencies and text samples."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideglass.functions.words import (
    ENGLISH_STOP_WORDS,
    is_content_word,
    is_word_piece,
    token_pieces,
    word_form,
)



def word_rows(
    df: DataFrame,
    text: str = "text",
    by: str | None = None,
    stop_words: Collection[str] = ENGLISH_STOP_WORDS,
) -> DataFrame:
    """T: one row per word occurrence. Exploding first keeps the word tests in generated code."""
    keys = [by] if by else []
    pieces = df.select(*keys, F.explode(token_pieces(F.col(text))).alias("_piece"))
    kept = pieces.filter(is_word_piece(F.col("_piece")))
    words = kept.select(*keys, word_form(F.col("_piece")).alias("word"))
    return words.filter(is_content_word(F.col("word"), stop_words))


def word_counts(
    df: DataFrame,
    text: str = "text",
    by: str | None = None,
    stop_words: Collection[str] = ENGLISH_STOP_WORDS,
) -> DataFrame:
    """Occurrences of each word, over all texts or per value of ``by``.

    Only partial counts are shuffled, so a word or label that fills the corpus costs one row per
    map task. Null texts add nothing.
    """
    keys = [by] if by else []
    words = word_rows(df, text, by, stop_words)
    return words.groupBy(*keys, "word").agg(F.count("*").alias("count"))


def top_words(
    df: DataFrame,
    text: str = "text",
    by: str | None = None,
    n: int = 20,
    stop_words: Collection[str] = ENGLISH_STOP_WORDS,
) -> DataFrame:
    """The ``n`` most frequent words, ties in word order; per value of ``by`` if given."""
    counts = word_counts(df, text, by, stop_words)
    order = [F.desc("count"), F.asc("word")]
    if by is None:
        return counts.orderBy(*order).limit(n)
    return first_per_group(counts, by, order, n).orderBy(by, *order)


#: Up to this ``n`` Spark itself limits groups before the shuffle.
PLANNED_LIMIT = 1_000
#: Parts that a group is dealt to before a larger ``n`` is taken of it.
PARTS = 64


def first_per_group(
    df: DataFrame, by: str, order: Sequence[Column], n: int, rank: str | None = None
) -> DataFrame:
    """First ``n`` rows per group. A task gets ``n`` rows per group from each map task at most; for
    an ``n`` beyond what Spark limits before the shuffle, from each of some parts of the group."""
    if n > PLANNED_LIMIT:
        part = F.pmod(F.xxhash64(*[F.col(f"`{name}`") for name in df.columns]), F.lit(PARTS))
        dealt = df.withColumn("_part", part)
        place = F.row_number().over(Window.partitionBy(by, "_part").orderBy(*order))
        df = dealt.withColumn("_place", place).filter(F.col("_place") <= n).drop("_part", "_place")
    position = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    ranked = df.withColumn(rank or "_rank", position).filter(F.col(rank or "_rank") <= n)
    return ranked if rank else ranked.drop("_rank")


def sample_paragraph(
    df: DataFrame,
    order_by: Sequence[str],
    text: str = "text",
    by: str | None = None,
    n: int = 5,
) -> DataFrame:
    """The first ``n`` texts joined by blanks; per value of ``by`` if given. Equal places in
    ``order_by`` go by text.
    """
    keys = [*([by] if by else []), *order_by]
    rows = df.select(*keys, F.col(text).alias("_text")).filter(F.col("_text").isNotNull())
    few = _first(rows, by, [*order_by, "_text"], n)
    in_order = F.array_sort(F.collect_list(F.struct(*order_by, "_text")))
    paragraph = F.array_join(F.transform(in_order, lambda row: row["_text"]), " ")
    return few.groupBy(*([by] if by else [])).agg(paragraph.alias("paragraph"))


def _first(df: DataFrame, by: str | None, order_by: Sequence[str], n: int) -> DataFrame:
    order = [F.asc(name) for name in order_by]
    return first_per_group(df, by, order, n) if by else df.orderBy(*order).limit(n)
