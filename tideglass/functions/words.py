"""Tokeniser T as Spark expressions.

A text is lower-cased, contraction endings become blanks, and it is split on white space and
punctuation. A piece is a word if, after trailing dots and quotes go, only letters are left and
there are at least three; so ``covid-19``, ``and/or`` and ``x2`` vanish whole instead of leaving fragments.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column
from pyspark.sql import functions as F

CONTRACTION_ENDINGS = r"(?:n't|'(?:s|re|ve|ll|d|m))\b"
LONG_BREAKS = r"--|\.{2,}"
ASCII_BREAKS = r"[\t\n\x0b\f\r ,;:?!()\[\]{}<>\"`@#$%&*]+"
ALL_BREAKS = r"[\t\n\x0b\f\r ,;:?!()\[\]{}<>\"`@#$%&*\p{Z}«»‘-’“-„]+"
TRAILING = ".'"
WORD_PIECE = r"^\p{L}{3,}[.']*$"

# Fused forms that count as two words. The second part is too short to count or a
# stop word, so only the first one is kept.
FUSED_FORMS = {
    "cannot": "can",
    "gimme": "gim",
    "gonna": "gon",
    "gotta": "got",
    "lemme": "lem",
    "wanna": "wan",
}

# The English stop words usual in NLP toolkits, all-letter entries only, since
# tokens with apostrophes never pass the letter test.
ENGLISH_STOP_WORDS = tuple("""
    i me my myself we our ours ourselves you your yours yourself yourselves
    he him his himself she her hers herself it its itself
    they them their theirs themselves what which who whom this that these those
    am is are was were be been being have has had having do does did doing
    a an the and but if or because as until while of at by for with about against
    between into through during before after above below to from up down in out on off
    over under again further then once here there when where why how
    all any both each few more most other some such no nor not only own same so than too very
    s t can will just don should now d ll m o re ve y
    ain aren couldn didn doesn hadn hasn haven isn ma mightn mustn needn shan shouldn
    wasn weren won wouldn
""".split())


def token_pieces(text: Column) -> Column:
    """Array of raw pieces of a text, words or not.

    The costly patterns run only on texts that a plain search says may hold something for them.
    """
    plain = F.lower(text)
    plain = F.when(
        text.contains("'"), F.regexp_replace(plain, CONTRACTION_ENDINGS, " ")
    ).otherwise(plain)
    plain = F.when(
        text.contains("--") | text.contains(".."), F.regexp_replace(plain, LONG_BREAKS, " ")
    ).otherwise(plain)
    is_ascii = F.octet_length(text) == F.length(text)
    return F.split(plain, F.when(is_ascii, ASCII_BREAKS).otherwise(ALL_BREAKS))


def is_word_piece(piece: Column) -> Column:
    """At least three letters and nothing else, but for trailing dots and quotes."""
    return piece.rlike(WORD_PIECE)


def word_form(piece: Column) -> Column:
    """The word a piece stands for: trailing dots and quotes off, fused forms cut to one word."""
    bare = F.rtrim(piece, F.lit(TRAILING))
    form = bare
    for fused, first in FUSED_FORMS.items():
        form = F.when(bare == fused, first).otherwise(form)
    return form


def is_content_word(form: Column, stop_words: Collection[str] = ENGLISH_STOP_WORDS) -> Column:
    return ~form.isin(*stop_words) if stop_words else F.lit(True)


def tokens(text: Column, stop_words: Collection[str] = ENGLISH_STOP_WORDS) -> Column:
    """Array of the words of a text, in order."""
    words = F.transform(F.filter(token_pieces(text), is_word_piece), word_form)
    return F.filter(words, lambda form: is_content_word(form, stop_words))
