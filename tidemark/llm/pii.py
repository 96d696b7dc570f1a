"""Personal data in texts: patterns propose spans, checksums confirm them, words nearby adjust the score.

DataFrame functions only. Positions are code points, ends exclusive. Within a kind, proposals are leftmost and do not
overlap; the patterns are written so that no character is looked at more than a few times (runs are taken whole and
start where a run starts, or where the last match ended).

Kinds: email, ip (parts at most 255), card (16 to 19 digits, Luhn), phone (8 to 15 digits), and iban (mod 97), which is
what the method adds. An iban has the length of its country and ends where a word ends, whatever follows; with a country
code that is not in ``IBAN_LENGTHS``, it is the longest run of words of 15 to 34 characters that is right. The score starts from how far a kind is confirmed by its form and rises with a context word of the
kind up to ``NEAR`` code points before or after it.

Defined results: a null or empty text has no spans; digits are ASCII digits; repeated rows are found each; an empty table
gives an empty result. Other columns are kept, ``spans`` is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.once import with_columns_once
from .common import shielded

NEAR = 40
#: What a context word adds to the score.
CONTEXT = 0.3


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: A text without this cannot hold the kind.
    needs: str
    score: float
    context: tuple[str, ...]
    #: Group of the pattern that is the proposal, and characters that a match takes if it only looks ahead at the rest.
    group: int = 0
    taken: int | None = None


#: Characters of an account number by country code.
IBAN_LENGTHS = {
    c: n
    for n, codes in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
        28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
        31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for c in codes.split()
}


def _iban() -> str:
    """Takes the country code and check digits and captures the whole number ahead, so that one proposal does not hide
    another that begins inside it."""
    known = "|".join(IBAN_LENGTHS)
    by_length = [
        rf"(?:{'|'.join(c for c in IBAN_LENGTHS if IBAN_LENGTHS[c] == n)})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}"
        for n in sorted({*IBAN_LENGTHS.values()})
    ]
    other = rf"(?!{known})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}}"
    return rf"(?<![A-Za-z0-9])(?=((?:{'|'.join([*by_length, other])})(?![A-Za-z0-9])))[A-Z]{{2}}[0-9]{{2}}"


_LOCAL = "[A-Za-z0-9._%+-]"
_DOMAIN = "[A-Za-z0-9-]"
KINDS = (
    Kind("email", rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_DOMAIN}++(?:\.{_DOMAIN}++)++", "@", 0.7, ("mail", "contact", "write")),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", 0.5, ("ip", "server", "host", "address")),
    Kind("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,}+", "", 0.6, ("card", "visa", "credit", "karte", "carte", "tarjeta")),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.4, ("phone", "call", "tel", "fax", "mobile")),
    Kind("iban", _iban(), "", 0.7, ("iban", "bank", "konto", "account"), 1, 4),
)
BASE = ("email", "ip", "card", "phone")
SPAN = "struct<kind:string,start:int,end:int,score:double>"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a right check digit: every second digit from the right doubled, digits summed."""
    n = F.length(digits)
    each = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(digits, i, F.lit(1)).cast("int"))
    weighed = F.transform(each, lambda d, i: F.when((n - i) % 2 == 0, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d))
    return (n > 0) & (F.aggregate(weighed, F.lit(0), lambda a, d: a + d) % 10 == 0)


def mod97(iban: Column) -> Column:
    """Whether an account number (letters and digits) leaves 1: the first four go last, letters count from 10."""
    moved = F.concat(F.substring(iban, 5, 60), F.substring(iban, 1, 4))
    chars = F.filter(F.split(moved, ""), lambda c: c != "")
    value = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    step = lambda a, c: F.when(value(c) > 9, (a * 100 + value(c)) % 97).otherwise((a * 10 + value(c)) % 97)
    return F.aggregate(chars, F.lit(0), step) == 1


def confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        parts = F.split(match, r"\.")
        value = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")  # noqa: E731  any number of leading zeros
        return F.forall(parts, lambda p: (F.length(value(p)) <= 3) & (F.coalesce(value(p).try_cast("int"), F.lit(999)) <= 255))
    if kind == "card":
        d = _digits(match)
        return F.when(F.length(d).between(16, 19), luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(8, 15)
    if kind == "iban":
        d = F.regexp_replace(match, r"\x20", "")
        return F.when(F.length(d).between(15, 34), mod97(d)).otherwise(False)
    return F.lit(True)


def _matches(text: Column, kind: Kind) -> tuple[Column, Column]:
    """The matches of a kind, and the text between them."""
    may = text.contains(kind.needs) if kind.needs else text.rlike("[0-9]{2}|[0-9][ -][0-9]")
    none = F.array().cast("array<string>")
    pattern = F.lit(kind.pattern)
    return (
        F.when(may, F.regexp_extract_all(text, pattern, F.lit(kind.group))).otherwise(none),
        F.when(may, F.transform(F.split(text, kind.pattern, -1), F.length)).otherwise(F.array().cast("array<int>")),
    )


def _running(lengths: Column, start: Column) -> Column:
    """Sums of what comes before each number. Quadratic, so for short arrays only."""
    zero = F.struct(start.alias("at"), F.array().cast("array<int>").alias("out"))
    step = lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out"))
    return F.aggregate(lengths, zero, step, lambda a: a["out"])


def _with_starts(rows: DataFrame, names: dict[str, int | None]) -> DataFrame:
    """``name`` (matches) and ``name_gap`` (lengths between them) become one array of (m, start, end); ``names`` gives the
    characters that each match takes, if they are not those of ``m``. Lengths are added up in blocks of about the root of their number, so that many matches in one text stay affordable."""
    empty = F.array().cast("array<array<int>>")

    def blocks(c: str) -> Column:
        size = F.ceil(F.sqrt(F.size(c))).cast("int")
        taken = lambda m: F.length(m) if names[c] is None else F.lit(names[c])
        lengths = F.transform(F.col(c), lambda m, i: taken(m) + F.get(F.col(f"{c}_gap"), i))
        last = F.ceil(F.size(c) / size).cast("int") - 1
        cut = F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(lengths, b * size + 1, size))
        return F.when(F.size(c) > 0, cut).otherwise(empty)

    rows = with_columns_once(rows, {f"{c}_blocks": blocks(c) for c in names})
    total = lambda x: F.aggregate(x, F.lit(0), lambda a, v: a + v)
    rows = with_columns_once(rows, {
        f"{c}_base": _running(F.transform(f"{c}_blocks", total), F.lit(0)) for c in names
    })

    def before(c: str) -> Column:
        return F.flatten(F.transform(f"{c}_blocks", lambda x, b: _running(x, F.get(F.col(f"{c}_base"), b))))

    rows = with_columns_once(rows, {f"{c}_before": before(c) for c in names})

    def placed(c: str) -> Column:
        def one(m: Column, i: Column) -> Column:
            start = F.get(F.col(f"{c}_before"), i) + F.get(F.col(f"{c}_gap"), i)
            return F.struct(m.alias("m"), start.alias("start"), (start + F.length(m)).alias("end"))

        return F.transform(F.col(c), one)

    return with_columns_once(rows, {f"{c}_at": placed(c) for c in names})


AT = "array<struct<m:string,start:int,end:int>>"


def accounts(found: Column) -> Column:
    """The account numbers among proposals (m, start, end)."""

    def best(m: Column) -> Column:
        words = F.split(m, " ")
        shorter = F.transform(F.sequence(F.size(words), F.lit(1), F.lit(-1)), lambda i: F.array_join(F.slice(words, 1, i), " "))
        tries = F.when(F.substring(m, 1, 2).isin(*IBAN_LENGTHS), F.array(m)).otherwise(shorter)
        return F.get(F.filter(tries, lambda x: confirmed("iban", x)), 0)

    cut = F.transform(found, lambda s: F.struct(best(s["m"]).alias("m"), s["start"].alias("start")))
    whole = lambda s: F.struct(s["m"].alias("m"), s["start"].alias("start"), (s["start"] + F.length(s["m"])).alias("end"))
    return F.transform(F.filter(cut, lambda s: s["m"].isNotNull()), whole).cast(AT)


def apart(found: Column) -> Column:
    """Spans without those that begin inside one before them that stays."""
    after = lambda spans, s, i: F.coalesce(F.get(spans, i)["end"] <= s["start"], F.lit(True))
    step = lambda kept, s: F.when(after(kept, s, F.size(kept) - 1), F.concat(kept, F.array(s))).otherwise(kept)
    clear = F.forall(F.transform(found, lambda s, i: after(found, s, i - 1)), lambda x: x)
    return F.when(clear, found).otherwise(F.aggregate(found, F.array().cast(AT), step))


def find_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``spans``: array of (kind, start, end, score) by kind in the order of ``KINDS``, then start."""
    docs, back = shielded(docs.drop("spans"), text)
    t = F.coalesce(F.col(text), F.lit(""))
    raw = {}
    for k in KINDS:
        raw[f"pii_{k.name}"], raw[f"pii_{k.name}_gap"] = _matches(t, k)
    rows = _with_starts(with_columns_once(docs, raw), {f"pii_{k.name}": k.taken for k in KINDS})
    rows = with_columns_once(rows, {"pii_iban_valid": accounts(F.col("pii_iban_at"))})
    rows = with_columns_once(rows, {"pii_iban_apart": apart(F.col("pii_iban_valid"))})

    def scored(k: Kind) -> Column:
        if k.name == "iban":
            good = F.col("pii_iban_apart")
        else:
            good = F.filter(F.col(f"pii_{k.name}_at"), lambda s: confirmed(k.name, s["m"]))
        words = "(?i)" + "|".join(k.context)

        def one(s: Column) -> Column:
            first = F.greatest(s["start"] - NEAR, F.lit(0))
            before = F.substring(t, first + 1, s["start"] - first)
            after = F.substring(t, s["end"] + 1, F.lit(NEAR))
            near = before.rlike(words) | after.rlike(words)
            score = F.when(near, F.lit(min(1.0, k.score + CONTEXT))).otherwise(F.lit(k.score))
            return F.struct(F.lit(k.name).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), score.alias("score"))

        return F.coalesce(F.transform(good, one), F.array().cast(f"array<{SPAN}>"))

    out = F.concat(*[scored(k).cast(f"array<{SPAN}>") for k in KINDS])
    return with_columns_once(rows, {"spans": out}).select(*back, "spans")


def redact(docs: DataFrame, text: str = "text", least: float = 0.5) -> DataFrame:
    """``docs(..., spans)`` with the spans of at least the given score in the text replaced by ``[KIND]``; where spans
    overlap, the first one counts."""
    chosen = F.sort_array(F.transform(
        F.filter("spans", lambda s: s["score"] >= least),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")),
    ))
    t = F.col(text)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        kept = F.concat(acc["out"], F.substring(t, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        free = s["start"] >= acc["at"]
        return F.struct(
            F.when(free, s["end"]).otherwise(acc["at"]).alias("at"), F.when(free, kept).otherwise(acc["out"]).alias("out")
        )

    done = F.aggregate(chosen, start, step, lambda acc: F.concat(acc["out"], F.substring(t, acc["at"] + 1, F.length(t))))
    return docs.withColumn(text, F.when(F.size("spans") > 0, done).otherwise(t))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
