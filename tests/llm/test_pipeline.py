"""The stages of the corpus pipeline against brute force over a small table, and the registered queries."""

import zlib

import documents as d
import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from test_simhash import groups, plain as fingerprint

import corpus_pipeline as pipeline
from tidemark.llm import decontaminate, mixing, tokens
from tidemark.llm.queries import QUERIES, TOKENIZERS

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before the first stage and after each."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for i, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        out.append(docs.collect())
    return out


def texts(rows):
    return {r.doc_id: r.text for r in rows}


def test_columns_are_those_of_documents(stages):
    for rows in stages[:5]:
        assert list(rows[0].asDict()) == pipeline.COLUMNS


def test_toxic_documents_go_and_clean_ones_stay(stages):
    before, after = texts(stages[0]), texts(stages[1])
    assert set(after) < set(before) and all(before[k] == t for k, t in after.items())
    labels = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    assert sum(labels.get(k) == 0 for k in before) - sum(labels.get(k) == 0 for k in after) <= 3


def test_one_of_each_group_stays(stages):
    before, after = texts(stages[1]), texts(stages[2])
    fps = {k: fingerprint(t) for k, t in before.items()}
    of = groups(set(fps.values()))
    least = {}
    for k in sorted(before):
        least.setdefault(of[fps[k]], k)
    assert set(after) == set(least.values())


def test_benchmark_passages_go(stages):
    before, after = texts(stages[2]), texts(stages[3])
    bench = [decontaminate.normal(r["text"]) for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist()]
    dirty = {k for k, t in before.items() if any(b in decontaminate.normal(t) for b in bench)}
    assert set(before) - set(after) == dirty


def test_the_mix_comes_near_its_targets(stages):
    before, after = stages[3], stages[4]
    words = lambda t: len(t.encode().split())
    size, taken, most = {}, {}, {}
    for r in before:
        size[r.source] = size.get(r.source, 0) + words(r.text)
        most[r.doc_id] = 3 * words(r.text)
    for r in after:
        taken[r.source] = taken.get(r.source, 0) + words(r.text)
        most[r.doc_id] -= words(r.text)
        assert r.n_chars == len(r.text)
    names = sorted(size, key=str.encode)
    want = mixing.targets([size[n] for n in names], [float(mixing.WEIGHTS[i % 3]) for i in range(len(names))])
    assert all(abs(taken.get(n, 0) - w) <= 0.01 * w + 1 for n, w in zip(names, want)) and min(most.values()) >= 0


def test_tokens_are_those_of_the_mix(stages):
    encoder = tokens.Encoder(f"{TOKENIZERS}/{tokens.VOCABULARY_FILE}")
    want = sorted((r.doc_id, zlib.crc32(np.frombuffer(x, encoder.kind).astype("<u4").tobytes())) for r, x in zip(
        stages[4], encoder.encode(r.text for r in stages[4])))
    got = sorted(stages[5], key=lambda r: r.start)
    assert sorted((r.doc_id, r.ids_crc32) for r in got) == want
    assert [r.doc_id for r in got] == sorted(r.doc_id for r in got)
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()


def awkward(spark):
    """Nulls in every column, empty and long texts, repeats, and columns that the stages use themselves."""
    names = ["input", "keep", "row_hash", "mix", "want", "taken", "ranges", "size", "spans", "hits", "fp", "score"]
    return d.table(spark).select(*pipeline.COLUMNS, *[F.lit(n).alias(n) for n in names])


@pytest.mark.parametrize("table", [awkward, d.empty, lambda s: d.empty(s).unionByName(s.createDataFrame([(None,) * 8] * 3, d.SCHEMA))])
def test_stages_on_awkward_tables(spark, tmp_path, table):
    docs = table(spark)
    for i, (name, stage) in enumerate(pipeline.STAGES):
        before = docs.count()
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        if i < 4:
            assert docs.columns == pipeline.COLUMNS, name
        if i < 3:
            assert docs.count() <= before
    assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_returns_its_columns(spark, name):
    first = {"op3_revisits": "record_id", "op12_hard_negatives": "anchor_id"}.get(name, "doc_id")
    df = QUERIES[name](spark, SF)
    assert df.columns[0] == first
    n = {"op3_revisits": 2 * spark.read.parquet(f"{SF}/pages.parquet").count(), "op12_hard_negatives": 250}.get(name, 200)
    assert df.count() == n or name == "op6_decontamination"
