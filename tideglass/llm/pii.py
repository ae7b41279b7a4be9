"""Personal data by weak supervision: labelers vote, EM learns how far to trust them, a classifier decides.

Base spans (email, ip, card, phone) are those of fixed patterns and checks. One more pattern finds
candidates beyond them: written-out addresses, IPv6, cards of 13 to 19 digits next to other numbers,
telephone numbers without a plus. Six labelers vote yes, no or nothing on each candidate and on base forms
alike: two patterns (form, checksum), gazetteers (domains, issuers, country codes, networks), the words
around, the variety of digits, and what touches the span. Expectation-maximisation over the counts of
votes estimates, by kind, how often each labeler says what of real and of other candidates; base forms are
known to be real, those that fail their check not to be. The probabilities that follow are the labels of
a logistic regression, which also sees the shape of a candidate. Candidates that it finds likelier than not, that their votes alone speak for,
and that no base span overlaps, are added.

Everything on the way is a DataFrame or SQL function. A text is read once; of it the spans alone are
written. What EM and the fit work on is one row per kind, shape and combination of votes, a few thousand at
most however many documents there are. All patterns go through a text in time linear in its length, and
none recurses, however long a run of letters or digits is.

A null or empty text has no spans. Repeated rows have equal results and count each in the estimates; extra
columns pass through whatever they are called. Without any candidate (as in an empty table) there is
no model and base spans alone are found. Spans count code points, the end is exclusive.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideglass.llm.common import materialize

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("form", "checksum", "gazetteer", "context", "variety", "edges")
#: Shapes a candidate can have: has separators or not, by four ranges of length.
SHAPES = 8

# The base patterns, in forms that match the same spans without going back over them.
_LOCAL = "[A-Za-z0-9._%+-]"
_EMAIL = r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++{_EMAIL}",
    "ip": rf"(?<![0-9]){_IP}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": _PHONE,
}
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

# Candidates. An address may be written out with brackets, or with the words "at" and "dot".
_AT = r"(?:\x20?(?:\[at\]|\(at\)|\{at\}|\x20@\x20)\x20?)"
_DOT = r"(?:\x20?(?:\[dot\]|\(dot\)|\{dot\}|\.)\x20?)"
_LABEL = "[A-Za-z0-9-]{1,63}"
_BRACKETED = rf"{_AT}{_LABEL}(?:{_DOT}{_LABEL}){{1,4}}"
_WORDED = rf"\x20at\x20{_LABEL}(?:\x20dot\x20{_LABEL}){{1,4}}"
_HEX = "[0-9A-Fa-f]{1,4}"
_SIX = rf"(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{1,6}}(?::{_HEX}){{1,6}}"
_CARDS = (
    r"[0-9]{4}(?:[\x20.-][0-9]{4}){3}(?![0-9])|3[0-9]{3}[\x20.-][0-9]{6}[\x20.-][0-9]{4,5}(?![0-9])"
    r"|[0-9]{13,19}(?![0-9])"
)
_PLAIN_PHONE = r"(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20.-])[0-9]{3,4}[\x20.-][0-9]{3,4}(?![\x20.-]?[0-9])"
CANDIDATE = (
    rf"(?<!{_LOCAL})(?:{_LOCAL}++(?:{_EMAIL}|{_BRACKETED}|{_WORDED})|(?<!:)(?:{_SIX})(?![0-9A-Za-z:])"
    rf"|{_IP}|{_PHONE}|{_CARDS}|(?<![0-9]\x20){_PLAIN_PHONE})"
)

# Gazetteers and context words.
_DOMAINS = "com|org|net|edu|gov|info|io|biz|eu|de|fr|es|it|nl|uk|us|ca|ch|at|br|mx|jp|cn|in|au|ru|pl|se"
_ISSUERS = "^(?:4|5[1-5]|2[2-7]|3[47]|3[0689]|6011|65|35|62)"
_COUNTRIES = "^(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|2[1-6][0-9]|3[578][0-9]|42[013])"
_SPECIFIC = {
    "email": "e-?mail|correo|courriel|contact|kontakt|write to|reach",
    "ip": r"\bip\b|address|host|server|adresse|login|from",
    "card": "card|visa|mastercard|amex|karte|carte|tarjeta|payment|credit|debit",
    "phone": r"phone|\btel\b|call|fax|mobile|cell|telefon|téléphone|teléfono|whatsapp",
}
_OTHERWISE = "isbn|issn|order|invoice|serial|version|release|chapter|figure|page|doi|part no|model|ticket"

#: What a text holds if a pattern matches anywhere in it; looked for first, being much quicker to find.
_NEEDED = {
    "email": lambda text: text.contains("@"),
    "phone": lambda text: text.contains("+"),
    "other": lambda text: text.contains("@") | text.contains("dot") | text.rlike("[0-9]"),
}


def _each(text: Column, name: str, pattern: str) -> Column:
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(_NEEDED[name](text), found) if name in _NEEDED else found


def _starts(lengths: Column) -> Column:
    """Where matches start, from the lengths of the part before each (``p``) and of itself (``v``).

    Running sums are made in groups of 256, so that growing an array costs little however many there are.
    """
    zero = F.lit(0).cast("long")
    groups = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / 256).cast("int")),
        lambda g: F.slice(lengths, g * 256 + 1, 256),
    )

    def total(group: Column) -> Column:
        return F.aggregate(group, zero, lambda s, x: s + x["p"] + x["v"])

    sums = F.aggregate(
        groups, F.array(zero), lambda s, g: F.concat(s, F.array(F.element_at(s, -1) + total(g)))
    )

    def inside(group: Column, at: Column) -> Column:
        nothing = F.array().cast("array<bigint>")
        return F.aggregate(
            group,
            F.struct(at.alias("at"), nothing.alias("out")),
            lambda s, x: F.struct(
                (s["at"] + x["p"] + x["v"]).alias("at"),
                F.concat(s["out"], F.array(s["at"] + x["p"])).alias("out"),
            ),
            lambda s: s["out"],
        )

    return F.flatten(F.zip_with(groups, F.slice(sums, F.lit(1), F.size(groups)), inside))


def _with_matches(rows: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """``rows`` with, for each pattern, the matches in column ``text`` as an array of structs: ``value``,
    ``start``, ``stop``, and up to 40 code points ``before`` and 8 ``after``. Each step is a projection of
    its own, so that no pattern is searched twice."""
    others = [c for c in rows.columns if c != "text"]
    found = rows.select(*others, "text", *[_each(F.col("text"), n, p).alias(n) for n, p in patterns.items()])

    def some(name: str, value: Column) -> Column:
        return F.when(F.size(name) > 0, value)

    parts = found.select(
        *others,
        *patterns,
        *[some(n, F.split("text", p, -1)).alias(f"{n}_parts") for n, p in patterns.items()],
    )
    lengths = parts.select(
        "*",
        *[
            some(
                n,
                F.zip_with(
                    F.slice(f"{n}_parts", F.lit(1), F.size(n)),
                    n,
                    lambda p, v: F.struct(
                        F.length(p).cast("long").alias("p"), F.length(v).cast("long").alias("v")
                    ),
                ),
            ).alias(f"{n}_lengths")
            for n in patterns
        ],
    )
    placed = lengths.select(
        *others,
        *patterns,
        *[f"{n}_parts" for n in patterns],
        *[some(n, _starts(F.col(f"{n}_lengths"))).alias(f"{n}_starts") for n in patterns],
    )

    def spans(name: str) -> Column:
        def span(value: Column, i: Column) -> Column:
            before, start = F.get(f"{name}_parts", i), F.get(f"{name}_starts", i)
            return F.struct(
                value.alias("value"),
                start.alias("start"),
                (start + F.length(value)).alias("stop"),
                F.right(before, F.lit(40)).alias("before"),
                F.left(F.get(f"{name}_parts", i + 1), F.lit(8)).alias("after"),
            )

        # Without matches nothing is looked up, and the array is empty.
        return F.transform(F.coalesce(name, F.array().cast("array<string>")), span)

    return placed.select(*others, *[spans(n).alias(n) for n in patterns])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits ends in its check digit."""

    def add(total: Column, c: Column) -> Column:
        x = c["d"].cast("int") * c["f"]
        return total + F.when(x > 9, x - 9).otherwise(x)

    doubled = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: F.struct(d.alias("d"), (i % 2 + 1).alias("f")),
    )
    doubled = F.filter(doubled, lambda c: c["d"] != "")
    return F.aggregate(doubled, F.lit(0), add) % 10 == 0


def _is_base(kind: str, value: Column) -> Column:
    """Whether a match of a base pattern passes the checks of its kind."""
    number = F.length(_digits(value))
    return {
        "email": F.lit(True),
        "ip": value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
        "card": number.between(16, 19) & F.when(number.between(16, 19), _luhn(_digits(value))),
        "phone": number.between(8, 15),
    }[kind]


def _vote(yes: Column, no: Column | None = None) -> Column:
    out = F.when(yes, 1)
    return (out if no is None else out.when(no, -1)).otherwise(0)


def _by_kind(kind: Column, votes: dict[str, Column]) -> Column:
    out = F
    for name in KINDS:
        if name in votes:
            out = out.when(kind == name, votes[name])
    return out.otherwise(0).cast("int")


def _described(match: Column) -> Column:
    """A candidate with its kind, digits and whether it is a base form."""
    value, digits = match["value"], _digits(match["value"])
    kind = (
        F.when(value.rlike(r"@|[\[({\x20][Aa][Tt][\])}\x20]"), "email")
        .when(value.contains(":") | value.rlike(rf"^{_IP}$"), "ip")
        .when(~value.startswith("+") & (F.length(digits) >= 13), "card")
        .otherwise("phone")
    )
    return F.struct(
        kind.alias("kind"),
        match["start"].alias("start"),
        match["stop"].alias("end"),
        value.alias("value"),
        digits.alias("digits"),
        F.lower(match["before"]).alias("before"),
        match["after"].alias("after"),
    )


def _labeled(c: Column) -> Column:
    """A candidate with its votes and shape, without the text around it."""
    value, digits, kind = c["value"], c["digits"], c["kind"]
    plus, six = value.startswith("+"), value.contains(":")
    form = {
        "email": _vote(~value.rlike(r"\x20(?:at|@)\x20")),
        "ip": _vote(six | _is_base("ip", value), ~six),
        "card": _vote(
            ~value.rlike("^[0-9]+$") | F.length(digits).isin(14, 15, 16, 19), F.length(digits).isin(13, 17, 18)
        ),
        "phone": _vote(
            (plus & _is_base("phone", value)) | value.rlike(r"^\([0-9]{3}\)\x20?[0-9]{3}[\x20.-][0-9]{4}$"),
            plus | ~value.rlike("^(?:[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}|[0(][0-9]{1,4}.*)$"),
        ),
    }
    checksum = {
        "email": _vote(value.rlike("[A-Za-z]{2,24}$"), F.lit(True)),
        "ip": _vote(six | ~value.rlike(r"(?:^|\.)0[0-9]"), F.lit(True)),
        "card": _vote(_luhn(digits), F.lit(True)),
    }
    gazetteer = {
        "email": _vote(value.rlike(rf"(?i)[^A-Za-z](?:{_DOMAINS})$")),
        "ip": _vote(
            value.rlike("^(?:[23][0-9A-Fa-f]{3}:|[fF][eE]80:|[fF][cdCD])")
            | (~six & value.rlike(r"^0*(?:[1-9]|[1-9][0-9]|1[0-9][0-9]|2[01][0-9]|22[0-3])\.")),
            ~six,
        ),
        "card": _vote(digits.rlike(_ISSUERS), F.lit(True)),
        "phone": _vote(
            (plus & digits.rlike(_COUNTRIES)) | (~plus & digits.rlike("^[2-9]")), plus | digits.startswith("1")
        ),
    }
    context = {
        k: _vote(c["before"].rlike(rf"(?:{words})[^.!?\n]*$"), c["before"].rlike(rf"(?:{_OTHERWISE})[^.!?\n]*$"))
        for k, words in _SPECIFIC.items()
    }
    different = F.size(F.array_distinct(F.filter(F.split(digits, ""), lambda d: d != "")))
    variety = {k: _vote(different >= 4, different <= 2) for k in ("card", "phone")}
    free = c["before"].rlike(r"(?:^|[\s(\[{<\"',;:|])$") | (F.length(c["before"]) == 0)
    edges = _vote(free & (~c["after"].rlike(r"^[\p{L}\p{N}_%$€=/\\]")), ~free)
    votes = [
        _by_kind(kind, form), _by_kind(kind, checksum), _by_kind(kind, gazetteer),
        _by_kind(kind, context), _by_kind(kind, variety), edges.cast("int"),
    ]
    length = F.length(value)
    size = F.when(length < 12, 0).when(length < 16, 1).when(length < 20, 2).otherwise(3)
    shape = size * 2 + value.rlike(r"[\x20()\[\]{}-]").cast("int")
    base = _by_kind(kind, {k: F.coalesce(_is_base(k, value), F.lit(False)).cast("int") for k in KINDS})
    form_of_base = F.when(kind == "phone", plus).when(kind == "email", ~value.rlike(r"[\x20\[({]")).otherwise(True)
    # What has a base form and fails its check, as a card number without its check digit does, is no data.
    failed = (
        F.when(kind == "card", ~_luhn(digits))
        .when(kind == "ip", ~six & (base == 0))
        .otherwise((kind == "phone") & plus & (base == 0))
    )
    return F.struct(
        kind.alias("kind"),
        c["start"].alias("start"),
        c["end"].alias("end"),
        F.when((base == 1) & form_of_base, 1).when(failed, -1).otherwise(0).alias("known"),
        F.array(*votes).alias("votes"),
        shape.cast("int").alias("shape"),
    )


def candidates(
    documents: DataFrame, text: str = "text", name: str = "found", keep_text: bool = False
) -> DataFrame:
    """``documents`` with a struct ``name``: ``base``, the base spans (``kind``, ``start``, ``end``) by kind
    and start, and ``others``, all candidates with their votes. The text itself goes unless it is kept."""
    names = [c for c in documents.columns if c != name and (keep_text or c != text)]
    kept = [f"c{i}" for i in range(len(names))]
    rows = documents.select(
        *[F.col(f"`{c}`").alias(k) for c, k in zip(names, kept)],
        F.col(f"`{text}`").cast("string").alias("text"),
    )
    found = _with_matches(rows, {**BASE, "other": CANDIDATE})

    def base(kind: str) -> Column:
        fine = F.filter(kind, lambda m: F.coalesce(_is_base(kind, m["value"]), F.lit(False)))
        return F.transform(
            fine,
            lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"), m["stop"].alias("end")),
        )

    described = found.select(
        *kept,
        F.concat(*[base(kind) for kind in KINDS]).alias("base"),
        F.transform("other", _described).alias("other"),
    )
    labeled = described.select(*kept, "base", F.transform("other", _labeled).alias("other"))
    return labeled.select(
        *[F.col(k).alias(c) for k, c in zip(kept, names)],
        F.struct("base", F.col("other").alias("others")).alias(name),
    )


@dataclass(frozen=True)
class SpanModel:
    """``intercept`` and ``weights`` of the classifier over ``_features``; by kind and labeler the
    ``reliability``: the probabilities of its votes no, nothing and yes on other and on real candidates;
    ``prior``, by kind the share of real ones of those not known before."""

    intercept: float
    weights: tuple[float, ...]
    reliability: dict[tuple[str, str], tuple[tuple[float, ...], tuple[float, ...]]]
    prior: dict[str, float]

    def likely(self, candidate: Column) -> Column:
        """Whether a candidate is likelier real than not, by the classifier and by its votes alone: what
        few examples were like cannot outweigh labelers that say no."""
        odds = _vote_odds(candidate["kind"], candidate["votes"], self.prior, self.reliability)
        return (self.logit(candidate) >= 0) & (odds >= 0)

    def logit(self, candidate: Column) -> Column:
        total = F.lit(self.intercept)
        for feature, weight in zip(_features(candidate), self.weights):
            if weight:
                total = total + feature * weight
        return total


def _features(c: Column) -> list[Column]:
    """Votes yes and no by kind and labeler, kinds and shapes, as 0 or 1."""
    votes = [
        (c["kind"] == k) & (F.get(c["votes"], F.lit(j)) == v)
        for k in KINDS
        for j in range(len(LABELERS))
        for v in (1, -1)
    ]
    kinds = [c["kind"] == k for k in KINDS]
    shapes = [c["shape"] == s for s in range(SHAPES)]
    return [x.cast("double") for x in (*votes, *kinds, *shapes)]


#: How a labeler is thought to vote (no, nothing, yes) on other and on real candidates before votes are
#: read, and as how many candidates this counts.
FIRST_GUESS, GUESS_WEIGHT = ((0.5, 0.3, 0.2), (0.1, 0.3, 0.6)), 20.0


def fit(found: DataFrame, name: str = "found", rounds: int = 25, tolerance: float = 1e-3) -> SpanModel | None:
    """Reliabilities by expectation-maximisation over the votes in ``found`` (of ``candidates``), where base
    forms are known to be real, and those that fail their check not to be, and the classifier trained on the
    probabilities they give; None where there is no candidate."""
    spark = found.sparkSession
    c = found.select(F.explode(f"{name}.others").alias("c")).select("c.kind", "c.votes", "c.shape", "c.known")
    counts = c.groupBy("kind", "votes", "shape", "known").agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(spark, counts.coalesce(1), "votes")
    if counts.isEmpty():
        return None

    def open_sum(w: str) -> Column:
        return F.sum(F.when(F.col("known") == 0, F.col(w)).otherwise(0.0)).alias(w)

    prior = dict.fromkeys(KINDS, 0.5)
    reliability = {(k, labeler): FIRST_GUESS for k in KINDS for labeler in LABELERS}
    for _ in range(rounds):
        weighed = _weighed(counts, prior, reliability)
        said = weighed.select("kind", "known", "w0", "w1", F.posexplode("votes").alias("j", "vote"))
        sums = said.groupBy("kind", "j", "vote", "known").agg(F.sum("w0").alias("w0"), F.sum("w1").alias("w1"))
        total: dict = defaultdict(float)
        for s in sums.collect():  # at most kinds x labelers x votes x 3 rows
            for w in ("w0", "w1"):
                total[s["kind"], s["j"], s["vote"], w] += s[w]
                if s["j"] == 0 and s["known"] == 0:
                    total[s["kind"], w] += s[w]
        before = reliability
        prior = {k: (total[k, "w1"] + 1) / (total[k, "w0"] + total[k, "w1"] + 2) for k in KINDS}
        reliability = {
            (k, labeler): tuple(
                _shares([total[k, j, vote, w] for vote in (-1, 0, 1)], guess)
                for w, guess in zip(("w0", "w1"), FIRST_GUESS)
            )
            for k in KINDS
            for j, labeler in enumerate(LABELERS)
        }
        moved = (
            abs(x - y)
            for key in reliability
            for one, other in zip(before[key], reliability[key])
            for x, y in zip(one, other)
        )
        if max(moved) < tolerance:
            break

    vector = array_to_vector(F.array(*_features(F.struct("kind", "votes", "shape"))))
    rows = _weighed(counts, prior, reliability).select(
        vector.alias("features"),
        F.explode(
            F.array(
                F.struct(F.lit(1.0).alias("label"), F.col("w1").alias("weight")),
                F.struct(F.lit(0.0).alias("label"), F.col("w0").alias("weight")),
            )
        ).alias("x"),
    )
    # A trace of either label keeps both classes there whatever the votes were.
    rows = rows.select("features", "x.label", (F.col("x.weight") + 1e-6).alias("weight"))
    model = LogisticRegression(weightCol="weight", regParam=1e-3, standardization=False, maxIter=60).fit(rows)
    weights = tuple(float(x) for x in model.coefficients)
    return SpanModel(float(model.intercept), weights, reliability, prior)


def _shares(sums: list[float], guess: tuple[float, ...]) -> tuple[float, ...]:
    total = sum(sums) + GUESS_WEIGHT
    return tuple((x + GUESS_WEIGHT * g) / total for x, g in zip(sums, guess))


def _vote_odds(kind: Column, votes: Column, prior, reliability) -> Column:
    """Log odds that a candidate with these votes is real."""
    ratios = [
        math.log(b / a) for k in KINDS for labeler in LABELERS for a, b in zip(*reliability[k, labeler])
    ]
    first = [math.log(prior[k] / (1 - prior[k])) for k in KINDS]
    number = F.array_position(F.array(*map(F.lit, KINDS)), kind).cast("int") - 1
    table = F.array(*map(F.lit, ratios))
    each = F.transform(votes, lambda v, j: F.get(table, number * (3 * len(LABELERS)) + j * 3 + v + 1))
    return F.aggregate(each, F.get(F.array(*map(F.lit, first)), number), lambda a, x: a + x)


def _weighed(counts: DataFrame, prior, reliability) -> DataFrame:
    """``counts`` with how many of each row's candidates are thought to be real (``w1``) and not
    (``w0``), by the odds that prior and votes give."""
    odds = _vote_odds(F.col("kind"), F.col("votes"), prior, reliability)
    real = F.when(F.col("known") == 1, 1.0).when(F.col("known") == -1, 0.0)
    real = real.otherwise(1 / (1 + F.exp(-odds)))
    p = counts.withColumn("p", real)
    return p.select("*", (F.col("n") * F.col("p")).alias("w1"), (F.col("n") * (1 - F.col("p"))).alias("w0"))


def decide(found: DataFrame, model: SpanModel | None, name: str = "found", to: str = "pii") -> DataFrame:
    """``found`` with ``to`` instead of ``name``: the base spans and those added, by kind and start, as
    structs ``kind``, ``start``, ``end``, ``base``."""

    def span(s: Column, base: bool) -> Column:
        return F.struct(s["kind"], s["start"], s["end"], F.lit(base).alias("base"))

    base = F.transform(f"{name}.base", lambda s: span(s, True))
    spans = base
    if model is not None:
        likely = F.filter(f"{name}.others", lambda c: (c["known"] == 0) & model.likely(c))
        free = F.filter(
            likely,
            lambda c: ~F.exists(
                f"{name}.base", lambda s: (s["start"] < c["end"]) & (c["start"] < s["end"])
            ),
        )
        spans = F.concat(base, F.transform(free, lambda c: span(c, False)))
    place = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    keyed = F.transform(spans, lambda s: F.struct(place[s["kind"]].alias("k"), s["start"].alias("a"), s.alias("s")))
    ordered = F.transform(F.array_sort(keyed), lambda x: x["s"])
    others = [F.col(f"`{c}`") for c in found.columns if c not in (name, to)]
    return found.select(*others, ordered.alias(to))


def pii_spans(documents: DataFrame, text: str = "text", to: str = "pii") -> DataFrame:
    """``documents`` without their texts and with the spans ``to`` of personal data in them (``decide``)."""
    name = "found"
    while name in documents.columns:
        name += "_"
    found = materialize(documents.sparkSession, candidates(documents, text, name), "pii")
    return decide(found, fit(found, name), name, to)


def redact(documents: DataFrame, model: SpanModel | None, text: str = "text", mask: str = "█") -> DataFrame:
    """``documents`` with each code point of personal data, as ``model`` finds it, masked."""
    name, to = "found", "pii"
    while name in documents.columns or to in documents.columns:
        name, to = name + "_", to + "_"
    spans = decide(candidates(documents, text, name, keep_text=True), model, name, to)
    value = F.col(f"`{text}`").cast("string")
    by_start = F.array_sort(
        F.transform(to, lambda s: F.struct(s["start"].cast("int").alias("start"), s["end"].cast("int").alias("end")))
    )
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def take(state: Column, s: Column) -> Column:
        begin = F.greatest(state["at"], s["start"])
        end = F.greatest(state["at"], s["end"])
        clear = F.substr(value, state["at"] + 1, begin - state["at"])
        return F.struct(
            end.alias("at"), F.concat(state["out"], F.array(clear, F.repeat(F.lit(mask), end - begin))).alias("out")
        )

    def finish(state: Column) -> Column:
        return F.concat(F.array_join(state["out"], ""), F.substr(value, state["at"] + 1, F.length(value)))

    masked = F.when(F.size(to) > 0, F.aggregate(by_start, nothing, take, finish)).otherwise(value)
    return spans.select(*[masked.alias(c) if c == text else F.col(f"`{c}`") for c in documents.columns])
