"""The manifest against a plain tree, tampering, and the awkward rows."""

import hashlib
from collections import defaultdict

import documents as d
import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle as m


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(nodes):
    """Root of a list of digests, and the siblings of each, level by level."""
    where, path = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for i, at in enumerate(where):
            run = nodes[at // 16 * 16:at // 16 * 16 + 16]
            path[i] += [x for j, x in enumerate(run) if j != at % 16]
            where[i] = at // 16
        nodes = [h(*nodes[i:i + 16]) for i in range(0, len(nodes), 16)]
    return nodes[0], path


def brute(rows):
    """(doc_id, leaf, subroot, root, proof) of rows (doc_id, source, leaf)."""
    of = defaultdict(list)
    for i, s, x in rows:
        of[s].append((i is not None, i or 0, x, i))
    sources = sorted(of, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([x[2] for x in sorted(of[s])]) for s in sources}
    root, above = climb([trees[s][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for r, own in zip(sorted(of[s]), trees[s][1]):
            out.append((repr(r[3]), r[2], trees[s][0], root, h(*own, *above[k])))
    return sorted(out)


def proofs(spark, rows, parts=3):
    df = spark.createDataFrame(rows, "doc_id long, source string, leaf string").repartition(parts)
    p = m.prove(df)
    got = p.select("load.doc_id", "leaf", "subroot", "root", F.sha2(m.siblings(F.col("path")), 256).alias("proof"),
                   m.fold(F.col("leaf"), F.col("path")).alias("folded"), m.fold(F.sha2(F.lit("x"), 256), F.col("path")).alias("other")).collect()
    assert all(r.folded == r.root != r.other for r in got)
    return sorted((repr(r.doc_id), r.leaf, r.subroot, r.root, r.proof) for r in got)


@pytest.mark.parametrize("counts", [[1], [2], [16], [17], [1, 1], [256, 1], [257, 33, 16], [15, 4097]])
def test_trees_of_many_sizes(spark, counts):
    rows = [(i * 7 - 3, None if s == 2 else f"s{s}", h(str((s, i)))) for s, n in enumerate(counts) for i in range(n)]
    assert proofs(spark, rows) == brute(rows)


def test_many_sources(spark):
    rows = [(i, f"é{i % 301}" if i % 5 else None, h(str(i))) for i in range(700)]
    assert proofs(spark, rows) == brute(rows)


def test_nulls_repeats_and_unlike_names(spark):
    rows = [(None, None, h("a")), (None, None, h("b")), (3, "", h("c")), (3, "", h("c")), (3, "", h("d")), (3, "-", h("c")),
            (-9, "=", h("e")), (2**62, "-=", h("f"))]
    assert proofs(spark, rows) == brute(rows)
    assert m.prove(spark.createDataFrame([], "doc_id long, source string, leaf string")).count() == 0


def test_leaves(spark):
    rows = [(1, "s", "en", 3, "añb"), (None, None, None, None, None), (-5, "", "", 0, ""), (2, "-", "1:x", 7, "x" * 200_000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert [r[0] for r in df.select(m.leaf(*[F.col(c) for c in m.FIELDS])).collect()] == [leaf(*r) for r in rows]


def test_columns_with_names_of_the_operator(spark):
    names = ["tree", "hash", "load", "pos", "total", "at", "part", "path", "above", "c0", "c", "level", "root"]
    df = spark.createDataFrame([(i, "s", h(str(i))) for i in range(20)], "doc_id long, source string, leaf string")
    wide = df.select("*", *[F.lit(n).alias(n) for n in names])
    got = m.prove(wide).select("load.*", F.col("root").alias("found")).collect()
    assert len(got) == 20 and all(r[n] == n for r in got for n in names) and {r.found for r in got} == {m_root(df)}


def m_root(df):
    return brute([(r.doc_id, r.source, r.leaf) for r in df.collect()])[0][3]


def test_what_was_altered_is_found(spark):
    docs = d.table(spark).select("doc_id", "source", "text")
    leaves = docs.select("doc_id", "source", m.leaf(F.col("doc_id"), F.col("text")).alias("leaf"),
                         m.leaf(F.col("doc_id"), F.upper("text")).alias("altered"))
    got = m.prove(leaves).select("leaf", "load.altered", "root", m.fold(F.col("load.altered"), F.col("path")).alias("folded")).collect()
    assert any(r.leaf == r.altered for r in got) and any(r.leaf != r.altered for r in got)
    assert all((r.folded == r.root) == (r.leaf == r.altered) for r in got)
