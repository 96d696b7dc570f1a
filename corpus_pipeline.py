"""From raw documents to token blocks: toxicity, near duplicates, decontamination, mixing, token output.

Each stage takes all that its predecessor kept and returns the columns of ``documents``; the last returns the index of
the token blocks it wrote: one row per document row of the mix, in ``doc_id`` order.

In every stage, null and empty texts are documents without words, rows that repeat are documents of their own until the near
duplicates go, an empty table gives an empty table, and columns besides those of ``documents`` are left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import decontaminate, mixing, simhash, tokens, toxicity
from tidemark.llm.common import saved
from tidemark.llm.queries import TOKENIZERS, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the model is fitted on the labelled ones among those given. Texts without words
    score 0 and stay; without labels of both kinds all stay. Rows without an id have no label but are scored."""
    model = toxicity.fit_on_labels(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest id (null last), of several the one with the smallest hash of
    all columns. Texts without words are one group, with whatever else is within the distance of fingerprint zero."""
    return simhash.drop_near_duplicates(docs).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark. Texts without words have none; benchmark items without an id count too."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes: a row per taken stretch of a document, documents taken more than once more than once. Texts without
    words are never taken; the null source is one source. ``n_chars`` is that of the stretch."""
    taken = mixing.mix(docs, cut="text")
    return taken.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token blocks of the mix, written to the shared folder and read back: ``doc_id, start, n_tokens, ids_crc32``.
    Rows without an id come last; those of one id are in the order of their texts' hash."""
    return tokens.read_documents(tokens.write_tokens(docs, f"{TOKENIZERS}/{tokens.VOCABULARY_FILE}"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_output", write_tokens),
]

#: The fitted toxicity model and the tokenizer have no SQL; a test compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
