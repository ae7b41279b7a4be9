"""Personal data against plain patterns, and what weak supervision adds."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F
from tideglass.llm import catalog, pii

#: The stated patterns, as they are.
STATED = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0


def stated(text):
    """Base spans, by the stated patterns and checks."""
    out = []
    for kind, pattern in STATED.items():
        for m in pattern.finditer(text or ""):
            value = m.group()
            digits = re.sub("[^0-9]", "", value)
            fine = {
                "email": True,
                "ip": kind == "ip" and all(int(part) <= 255 for part in value.split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if fine:
                out.append((kind, m.start(), m.end()))
    return out


def card(draw, length, prefix="4"):
    body = prefix + "".join(draw.choice("0123456789") for _ in range(length - 1 - len(prefix)))
    return next(body + c for c in "0123456789" if luhn(body + c))


def noise(draw):
    return "".join(draw.choice("aA.9@+-( )0é,:12345\n") for _ in range(draw.randint(0, 60)))


CASES = [
    None, "", " \n", "a@b.c_d@e.f a@b.c.@d.e x@y.@z.w a@b@c.d @x.y", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.4 1.2.3",
    "été \U0001f600 +1 (171) 555-2028 +12345678 +1234567 +1 2+3 44 55 66 77", "x" * 50_000 + "@a.b",
    "9" * 50_000, "1 " * 20_000, "a." * 20_000 + "@b", "+" + "1 " * 20_000, "a@" + "b." * 20_000,
    "4111 1111 1111 1111 4111-1111-1111-1112 1 4111111111111111",
]


def test_base_spans_equal_the_stated_patterns(spark):
    draw = random.Random(6)
    texts = CASES + [" ".join(noise(draw) for _ in range(3)) for _ in range(300)]
    texts += [f"{noise(draw)} {card(draw, draw.choice([15, 16, 17, 19]))} {noise(draw)}" for _ in range(60)]
    texts.append(" ".join(f"n{i}@mail.example.com 10.0.0.{i % 300}" for i in range(3000)))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = pii.candidates(frame).select("doc_id", "found.base").collect()
    assert len(found) == len(texts)
    for row in found:
        assert [tuple(s) for s in row["base"]] == stated(texts[row["doc_id"]]), texts[row["doc_id"]][:200]


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(pii.candidates(corpus(spark)))


def corpus(spark):
    draw = random.Random(2)
    rows = []
    for i in range(400):
        wrong = card(draw, 16)
        wrong = wrong[:-1] + str((int(wrong[-1]) + 1 + i % 8) % 10)
        rows.append(
            f"write to u{i}@mail.example.com or from host 10.{i % 250}.3.7, card {card(draw, 16)} "
            f"number {wrong} call +1 (202) 555-{1000 + i}."
        )
    return spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")


ADDED = [
    ("mail me: jane.roe [at] example [dot] com please", "email", "jane.roe [at] example [dot] com"),
    ("host 2001:db8:85a3:8d3:1319:8a2e:370:7348 is up", "ip", "2001:db8:85a3:8d3:1319:8a2e:370:7348"),
    ("amex card 378282246310005 was charged", "card", "378282246310005"),
    ("call (202) 555-0143 today", "phone", "(202) 555-0143"),
]
LEFT_ALONE = [
    "order 4111111111111112 shipped", "version 10.2.300.4", "figure 12-345-678, pages 100 200 300",
    "at 12:30:45 on 2024-01-02", "std::vector and a::b", "meet at noon dot", "call +12345", "isbn 9783161484100",
]


def test_what_is_added_and_what_is_left_alone(spark, model):
    texts = [t for t, _, _ in ADDED] + LEFT_ALONE
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pii.decide(pii.candidates(frame), model).collect()
    found = {r["doc_id"]: [(s["kind"], texts[r["doc_id"]][s["start"] : s["end"]]) for s in r["pii"]] for r in rows}
    for i, (_, kind, value) in enumerate(ADDED):
        assert found[i] == [(kind, value)], (texts[i], found[i])
    for i, text in enumerate(LEFT_ALONE, len(ADDED)):
        assert found[i] == [], (text, found[i])


def test_labelers_are_told_apart(model):
    other, real = model.reliability["card", "checksum"]
    assert real[2] > 0.9 and other[0] > 0.9
    assert all(abs(sum(p) - 1) < 1e-9 for pair in model.reliability.values() for p in pair)


def test_odd_texts_clashing_names_and_no_rows(spark, odd, none):
    clash = odd.withColumnRenamed("node", "found").withColumnRenamed("kept", "other").withColumnRenamed("piece", "email")
    found = pii.pii_spans(clash)
    assert found.columns == [c for c in clash.columns if c != "text"] + ["pii"]
    rows = found.collect()
    assert len(rows) == clash.count() and {r["found"] for r in rows} == {"a"} and {r["email"] for r in rows} == {1}
    assert all(r["pii"] == [] for r in rows)
    assert pii.pii_spans(none).collect() == []
    assert pii.fit(pii.candidates(none)) is None
    repeated = spark.createDataFrame([(1, "a@b.cd"), (1, "a@b.cd"), (None, "a@b.cd")], "doc_id long, text string")
    assert [len(r["pii"]) for r in pii.pii_spans(repeated).collect()] == [1, 1, 1]


def test_redacted_texts(spark, model):
    rows = [(1, "to a.b@c.de and (202) 555-0143, é 10.0.0.1"), (2, "nothing"), (3, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("found", F.lit("x"))
    masked = pii.redact(frame, model)
    assert masked.columns == frame.columns
    texts = {r["doc_id"]: r["text"] for r in masked.collect()}
    assert texts == {1: f"to {'█' * 8} and {'█' * 14}, é {'█' * 8}", 2: "nothing", 3: None}


def test_query_runs_no_python_and_equals_the_stated_patterns(spark, sf_dir):
    found = catalog.QUERIES["op11_weak_supervision_pii"](spark, sf_dir)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = found.collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = stated(texts[r["doc_id"]])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(filter(None, r["spans"].split(",")))
        for kind in pii.KINDS:
            assert r[f"n_{kind}"] == sum(k == kind for k, _, _ in base)
