"""Quality rules whose limits follow the data: quantile sketches per language and source in place of fixed cut-offs.

DataFrame functions only. A sketch counts values in buckets whose width grows with the value (relative error ``ALPHA``),
so sketches merge by adding counts, in any order. A document fails when one of its figures is beyond its group's fence,
``median + SPREADS * (upper quartile - median) + slack``. A group with few documents uses the sketch of its language,
merged from all its sources, and a language with few uses that of everything.

Defined results: a null or empty text has no words and fails the base rule; null language and source are groups like any
other; repeated rows count as rows; an empty table gives an empty result. Other columns are kept; added columns replace
columns of their name. Windows of words are compared by a 64-bit hash within one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.once import with_columns_once
from .common import SPACE, free_name, saved, shielded

SYMBOLS = "[#*$%&|<>]"
SPAN = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
#: Relative error of the sketches, values that count as zero, and the smallest group with limits of its own.
ALPHA, ZERO, MIN_GROUP = 0.01, 1e-6, 200
SPREADS = 6.0
#: Figure and slack: how far beyond the group's usual spread is still accepted.
FIGURES = {"symbol_share": 0.05, "repeat_share": 0.1, "repeated_line_share": 0.2, "mean_word": 4.0}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def repeated_words(words: Column, span: int = SPAN) -> Column:
    """Words that lie in a window of ``span`` words found twice or more; ``words`` must be a plain column."""
    last = F.size(words) - span
    hashes = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(span)]))
    return F.when(last < 0, F.array().cast("array<bigint>")).otherwise(hashes)


def _covered(hashes: Column, span: int = SPAN) -> Column:
    """Words covered by the windows whose hash occurs again; ``hashes`` must be a plain column."""
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), placed)


def text_figures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the figures of its texts: the columns of ``BASE`` and the shares of ``FIGURES``."""
    docs, back = shielded(docs.drop(*BASE, *FIGURES), text)
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    rows = with_columns_once(docs, {
        "qr_words": F.filter(F.split(t, f"[{SPACE}]+"), lambda w: w != ""), "qr_lines": lines,
        "n_symbols": F.regexp_count(t, F.lit(SYMBOLS)).cast("long"),
        "word_chars": (F.length(t) - F.regexp_count(t, F.lit(f"[{SPACE}]"))).cast("long"),
    })
    rows = with_columns_once(rows, {
        "qr_hashes": repeated_words(F.col("qr_words")), "n_words": F.size("qr_words").cast("long"),
        "n_lines": F.size("qr_lines").cast("long"),
        "n_dup_lines": (F.size("qr_lines") - F.size(F.array_distinct("qr_lines"))).cast("long"),
    }).drop("qr_words", "qr_lines")
    rows = with_columns_once(rows, {"qr_placed": _covered(F.col("qr_hashes"))}).drop("qr_hashes")
    s = F.col("qr_placed")
    again = F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]))
    rows = with_columns_once(rows, {"qr_starts": F.sort_array(F.transform(again, lambda x: x["i"]))}).drop("qr_placed")
    starts = F.col("qr_starts")
    gaps = F.transform(starts, lambda p, k: F.least(F.lit(SPAN), p - F.coalesce(F.get(starts, k - 1), F.lit(-SPAN))))
    rows = rows.withColumn(
        "n_repeat_words", F.coalesce(F.aggregate(gaps, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")
    ).drop("qr_starts")
    n = F.greatest("n_words", F.lit(1))
    derived = {
        "base_failed": (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        "symbol_share": F.col("n_symbols") / F.greatest("word_chars", F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / n,
        "repeated_line_share": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "mean_word": F.col("word_chars") / n,
    }
    return rows.select(*back, *[c for c in BASE if c not in derived], *[v.alias(c) for c, v in derived.items()])


def bucket(value: Column, alpha: float = ALPHA) -> Column:
    """Number of the sketch bucket of a value that is not negative; the lowest stands for zero."""
    gamma = (1 + alpha) / (1 - alpha)
    return F.when(value <= ZERO, F.lit(-1_000_000)).otherwise(F.ceil(F.log(value) / F.log(F.lit(gamma))).cast("int"))


def bucket_value(no: Column, alpha: float = ALPHA) -> Column:
    gamma = (1 + alpha) / (1 - alpha)
    return F.when(no == -1_000_000, F.lit(0.0)).otherwise(2 * F.pow(F.lit(gamma), no) / (gamma + 1))


def sketches(figures: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``(lang, source, figure, bucket, n)``: one sketch per language, source and figure. Tasks add up first, so a hot
    source sends one row per task and bucket."""
    values = F.explode(F.array(*[F.struct(F.lit(f).alias("figure"), F.col(f).alias("value")) for f in FIGURES]))
    rows = figures.select(F.col(lang).alias("lang"), F.col(source).alias("source"), values.alias("v"))
    return rows.groupBy("lang", "source", F.col("v.figure").alias("figure"), bucket(F.col("v.value")).alias("bucket")).agg(
        F.count("*").alias("n")
    )


def _fences(merged: DataFrame, by: list[str]) -> DataFrame:
    """One row per group with its number of documents and a fence per figure. A window sees the buckets of one group and
    figure, a number that the sketch bounds."""
    each = W.partitionBy(*by, "figure")
    rows = merged.withColumn("upto", F.sum("n").over(each.orderBy("bucket"))).withColumn("total", F.sum("n").over(each))
    at = {p: F.min(F.when(F.col("upto") >= p * F.col("total"), F.col("bucket"))) for p in (0.5, 0.75)}
    per = rows.groupBy(*by, "figure").agg(F.max("total").alias("total"), at[0.5].alias("b50"), at[0.75].alias("b75"))
    low, high = bucket_value(F.col("b50")), bucket_value(F.col("b75"))
    fence = low + SPREADS * (high - low)
    pick = [F.max(F.when(F.col("figure") == f, fence + slack)).alias(f"fence_{f}") for f, slack in FIGURES.items()]
    return per.groupBy(*by).agg(F.max("total").alias("docs"), *pick)


def fences(sketch: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """``(lang, source, fence_...)`` for every group: its own, its language's or the overall fences."""
    names = [f"fence_{f}" for f in FIGURES]
    own = _fences(sketch, ["lang", "source"])
    language = _fences(sketch.groupBy("lang", "figure", "bucket").agg(F.sum("n").alias("n")), ["lang"])
    overall = _fences(sketch.groupBy("figure", "bucket").agg(F.sum("n").alias("n")), [])
    wide = language.select(F.col("lang").alias("l"), F.col("docs").alias("l_docs"), *[F.col(c).alias(f"l_{c}") for c in names])
    all_ = overall.select(*[F.col(c).alias(f"a_{c}") for c in names])
    joined = own.join(wide, own["lang"].eqNullSafe(F.col("l"))).join(F.broadcast(all_))  # one row
    enough, spoken = F.col("docs") >= min_group, F.col("l_docs") >= min_group
    return joined.select(
        "lang", "source",
        *[F.when(enough, F.col(c)).when(spoken, F.col(f"l_{c}")).otherwise(F.col(f"a_{c}")).alias(c) for c in names],
    )


def judge(figures: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """A table of ``text_figures`` with ``kept``: passes the base rule and lies within the fences of its group. The table
    is read twice, so it should be a stored one."""
    limits = saved(fences(sketches(figures, lang, source)), "rules-fences")
    figures = figures.drop("kept")
    own = free_name(figures, "fences")
    of = lambda c: F.col(own).getField(c)
    same = figures[lang].eqNullSafe(of("lang")) & figures[source].eqNullSafe(of("source"))
    ok = ~F.col("base_failed")
    for f in FIGURES:
        ok = ok & (F.col(f) <= of(f"fence_{f}"))
    # One small row per group: Spark broadcasts it or splits the hot group of a sorted join.
    return figures.join(limits.select(F.struct("*").alias(own)), same).select(*figures.columns, ok.alias("kept"))


def apply_rules(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``docs`` with the columns of ``BASE``, the figures and ``kept``."""
    return judge(saved(text_figures(docs, text), "rules"), lang, source)
