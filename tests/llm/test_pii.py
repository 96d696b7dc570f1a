"""Spans against Python's regular expressions, checksums, scores and redaction."""

import random
import re

import documents as d
import pytest
from pyspark.sql import functions as F

from tidemark.llm import pii as p


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def plain(t):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    find = lambda pattern: re.finditer(pattern, t)
    out = [("email", m) for m in find(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")]
    out += [("ip", m) for m in find(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)") if all(int(x) <= 255 for x in m.group().split("."))]
    out += [("card", m) for m in find(r"[0-9]([\x20-]?[0-9])+") if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [("phone", m) for m in find(r"\+[0-9][\x20().0-9-]+[0-9]") if 8 <= len(digits(m)) <= 15]
    return [(k, *m.span()) for k, m in out]


CARD = "4111 1111 1111 1111"
TEXTS = [
    f"mail me: a.b+c@x-y.co.uk, or {CARD} now", "a@b.c.d_e@f.g x@y", "@a.b a@.b a@b..c a@b.c.", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.255",
    "0000000000000255.1.1.1 1.2.3", "4111-1111-1111-1111-2 4111111111111111", "1 2 3  4111 1111 1111 1112", "+1 (555) 123-4567) ++49 30.123456 +1 2",
    "+1 234 567 890 123 456 789", "IBAN DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432", "iban DE89 3704 0044 0532 0130 01",
    "üñ \U0001f600 a@b.de \U0001f600 10.0.0.1", "a" * 3000 + "@", "1" * 5000, "1 " * 3000, "1.1.1.1 " * 700, "+" * 500 + "1" * 30,
    "a@b.c" * 50, "@" * 2000, "1-" * 4000 + "1",
]


def spans(df):
    return {r.doc_id: [tuple(s) for s in r.spans] for r in p.find_spans(df).collect()}


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_base_spans(spark):
    rng = random.Random(3)
    bits = ["a@b.co", "1.2.3.4", CARD, "+1 555 123 4567", " ", "  ", ".", "-", "@", "7", "x", "256", "\n", ",", "_", "é", "+"]
    texts = TEXTS + ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 40))) for _ in range(400)]
    got = spans(table(spark, texts))
    for i, t in enumerate(texts):
        assert [s[:3] for s in got[i] if s[0] in p.BASE] == plain(t), repr(t[:200])


def test_accounts_and_context(spark):
    got = spans(table(spark, TEXTS))
    assert [TEXTS[9][s[1]:s[2]] for s in got[9]] == ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"]
    assert got[10] == []
    near, far = spans(table(spark, [f"my visa card {CARD}", f"{CARD}"]))[0], spans(table(spark, ["", f"{CARD}"]))[1]
    assert near[0][3] == pytest.approx(0.9) and far[0][3] == pytest.approx(0.6)


@pytest.mark.parametrize("number", ["79927398713", "4111111111111111", "0"])
def test_luhn(spark, number):
    df = spark.createDataFrame([(number[:-1] + str(x),) for x in range(10)], "n string")
    assert [r[0] for r in df.select(p.luhn(F.col("n"))).collect()] == [luhn(number[:-1] + str(x)) for x in range(10)]


def test_redaction(spark):
    found = p.find_spans(table(spark, [f"to a@b.co and {CARD}!", "", "clean", "1.2.3.4"]))
    got = {r.doc_id: r.text for r in p.redact(found, least=0.5).collect()}
    assert got == {0: "to [EMAIL] and [CARD]!", 1: "", 2: "clean", 3: "[IP]"}
    assert {r.text for r in p.redact(found, least=0.99).collect()} == {r.text for r in found.collect()}


def test_awkward_tables(spark):
    t = d.table(spark)
    out = p.find_spans(t)
    assert out.count() == t.count() and out.filter("text is null").select(F.size("spans")).distinct().collect() == [(0,)]
    assert p.find_spans(d.empty(spark)).count() == 0
    assert set(out.columns) == set(t.columns)
    assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().toString())


def numbered(code, body):
    """An account number with right check digits."""
    value = "".join(str(int(c, 36)) for c in body + code + "00")
    return f"{code}{98 - int(value) % 97:02d}{body}"


def spaced(number):
    return " ".join(number[i : i + 4] for i in range(0, len(number), 4))


def test_accounts_before_anything(spark):
    rng = random.Random(8)
    numbers = ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"]
    for code in ("NO", "BE", "FR", "MT", "LC", "RU", "NL", "PL"):
        number = numbered(code, "".join(rng.choice("0123456789AZ") for _ in range(p.IBAN_LENGTHS[code] - 4)))
        numbers += [number, spaced(number)]
    numbers += [numbered("ZZ", "12345678901234567"), spaced(numbered("ZZ", "1234567890123456"))]
    tails = ["", " Please pay", " BIC COBADEFFXXX", " 2024", " 1 2", " A", ", DE", " and", ". X", " DE89 3704 0044", "\nNO 7"]
    cases = [(n, t) for n in numbers for t in tails if not n.startswith("ZZ") or t[:2] not in (" 1", " 2", " A", " B", " D")]
    texts = [f"Konto {n}{t}" for n, t in cases] + [f"{numbers[0]} {numbers[1]}", f"AT12 {numbers[0]} X", f"{numbers[1]}9", f"x{numbers[1]}"]
    got = spans(table(spark, texts))
    found = [[texts[i][s[1]:s[2]] for s in got[i] if s[0] == "iban"] for i in range(len(texts))]
    for (n, _), text, f in zip(cases, texts, found):
        assert f == [n], text
    assert found[len(cases):] == [numbers[:2], numbers[:1], [], []]


def test_accounts_do_not_overlap(spark):
    spans = [("a", 0, 10), ("b", 5, 15), ("c", 12, 20), ("d", 20, 22)]
    df = spark.createDataFrame([(spans,), (spans[2:],), ([],)], f"x {p.AT}")
    assert [[s.m for s in r[0]] for r in df.select(p.apart(F.col("x"))).collect()] == [["a", "c", "d"], ["c", "d"], []]
