"""The registered queries of this package: each applies one operator, with its production parameters, to a whole table."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import decontaminate, exact, merkle, mixing, negatives, pii, quality, rules, simhash, suffix, tokens, toxicity, warc
from .common import ascii_lower, fold_of, saved, training_labels

TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", quality.text_statistics("text").alias("stats"))
    docs = saved(docs.withColumn("held_out", fold_of("doc_id", 3) == 1), "op1")
    picked = training_labels(table(spark, folder, "labels"), "quality", 1, 3, quality.MAX_TRAIN)
    model = quality.fit(docs.join(picked, "doc_id"))
    scored = docs.select("doc_id", "held_out", quality.quality("stats", model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op2_token_output(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return tokens.read_documents(tokens.write_tokens(docs, f"{TOKENIZERS}/{tokens.VOCABULARY_FILE}"))


def page_captures(spark: SparkSession, folder: str) -> DataFrame:
    """Each page as a full response and, a thousand time steps later, a revisit of its address. Revisits carry an entity
    tag, a date or no validator, by the page's number."""
    pages = table(spark, folder, "pages")
    p = F.col("page_id")
    tag = F.concat(F.lit('"'), F.md5("html"), F.lit('"'))
    date = F.date_format(F.timestamp_seconds(p * 60), "yyyy-MM-dd'T'HH:mm:ss")
    first = F.create_map(
        F.lit("ETag"), tag, F.lit("Last-Modified"), date, F.lit("Content-Length"), F.octet_length("html").cast("string"),
        F.lit("X-Cache"), F.lit("miss"),
    )
    again = F.map_filter(
        F.create_map(
            F.lit("etag"), F.when(p % 3 == 0, F.concat(F.lit("W/"), tag)), F.lit("last-modified"), F.when(p % 3 == 1, date),
            F.lit("Content-Length"), F.lit("0"), F.lit("X-Cache"), F.lit("hit"),
        ),
        lambda k, v: v.isNotNull(),
    )
    both = F.array(
        F.struct((p * 2).alias("record_id"), F.lit("response").alias("kind"), p.alias("time"), first.alias("headers"), F.col("html").alias("payload")),
        F.struct((p * 2 + 1).alias("record_id"), F.lit("revisit").alias("kind"), (p + 1000).alias("time"), again.alias("headers"), F.lit(None).cast("string").alias("payload")),
    )
    return pages.select("url", F.inline(both))


def op3_revisits(spark: SparkSession, folder: str) -> DataFrame:
    found = warc.resolve_revisits(page_captures(spark, folder))
    h = F.col("headers")
    return found.select(
        "record_id", "kind", "canonical", "status", "source_id", h["etag"].alias("etag"),
        h["last-modified"].alias("last_modified"), h["content-length"].alias("content_length"), h["x-cache"].alias("x_cache"),
        F.md5("payload").alias("payload_md5"),
    )


def op4_rules(spark: SparkSession, folder: str) -> DataFrame:
    figures = rules.text_figures(table(spark, folder, "documents")).drop("text", "n_chars")
    judged = rules.judge(saved(figures, "op4"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op5_repeats(spark: SparkSession, folder: str) -> DataFrame:
    kept = suffix.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """The contaminated documents: a row for each stretch that matches a benchmark item."""
    return decontaminate.find_contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_spans(table(spark, folder, "documents").select("doc_id", "text"))
    of = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE))
    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in pii.BASE],
        F.sha2(pii.joined(base), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"),
        F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",").alias("scores"),
    )


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", mixing.n_words("text").alias("size"))
    mixed = mixing.mix(saved(docs, "op8"), F.col("size"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit_on_labels(docs, table(spark, folder, "labels"))
    scored = docs.select(
        "doc_id", (fold_of("doc_id", 4) == 2).alias("held_out"), toxicity.toxicity("text", model).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", simhash.simhash("text").alias("fp"))
    groups = simhash.near_duplicate_groups(docs)
    return groups.select("doc_id", simhash.hex64("fp").alias("fingerprint"), "component_id")


def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """Proofs of all documents. Where the checksum of the id is a multiple of 5 the proof is tried with an altered text."""
    value = {c: F.col(c) for c in merkle.FIELDS}
    altered = merkle.leaf(*(value | {"text": ascii_lower(F.col("text"))}).values())
    leaves = table(spark, folder, "documents").select(
        "doc_id", "source", merkle.leaf(*value.values()).alias("leaf"), F.when(fold_of("doc_id", 5) == 0, altered).alias("altered")
    )
    proofs = merkle.prove(leaves)
    folded = merkle.fold(F.coalesce("load.altered", "leaf"), F.col("path"))
    return proofs.select(
        "load.doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Every hundredth vector against all vectors; every seventh has the next label."""
    rows = table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0, label=moved)


def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = exact.duplicate_groups(table(spark, folder, "documents"))
    return groups.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality, op2_token_output, op3_revisits, op4_rules, op5_repeats, op6_decontamination, op7_pii,
        op8_mixing, op9_toxicity, op10_simhash, op11_merkle, op12_hard_negatives, op13_exact_dedup,
    )
}
