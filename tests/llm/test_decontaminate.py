"""Planted passages, edits up to the budget, and clean documents."""

import random

import documents as d
import numpy as np
import pytest

from tidemark.llm import decontaminate as c


def passages(n=12):
    rng = random.Random(4)
    return [(i, d.prose(rng, 30)) for i in range(n)]


def edited(rng, text, edits):
    for _ in range(edits):
        p = rng.randrange(len(text))
        text = rng.choice([text[:p] + text[p + 1:], text[:p] + "q" + text[p:], text[:p] + "q" + text[p + 1:]])
    return text


def plain_edits(pattern, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_windows_within_the_budget_are_found():
    rng = random.Random(9)
    items = passages()
    index = c.Index(items)
    for trial in range(150):
        item, passage = rng.choice(items)
        a = rng.randrange(len(passage) - c.WINDOW)
        window = c.normal(passage)[a : a + c.WINDOW]
        if len(window) < c.WINDOW:
            continue
        around = d.prose(rng, 40), d.prose(rng, 40)
        text = around[0] + " " + edited(rng, window, rng.randrange(c.EDITS + 1)) + " " + around[1]
        assert item in {h[0] for h in index.search([text])[0]}, trial


def test_hits_are_right_and_clean_texts_have_none():
    rng = random.Random(5)
    items = passages()
    index = c.Index(items)
    texts = [d.prose(rng, 300) for _ in range(60)] + [None, "", "x"]
    assert not any(index.search(texts))
    texts = [f"{d.prose(rng, 50)} \n\t {t.upper()}\n{d.prose(rng, 50)}" for _, t in items]
    for (item, passage), text, hits in zip(items, texts, index.search(texts)):
        (hit,) = [h for h in hits if h[0] == item]
        assert hit[3] == 0 and c.normal(passage) in c.normal(text[hit[1]:hit[2]])
        assert len(text[hit[1]:hit[2]]) < len(passage) + 30


def test_short_items_are_found_whole():
    index = c.Index([(1, "Only a short item"), (2, ""), (3, None), (4, "only a short item")])
    assert [h[0] for h in index.search(["before ONLY a  short item after"])[0]] == [1, 4]
    assert index.search(["only a short"])[0] == []


@pytest.mark.parametrize("chars", [10**7, 400])
def test_tables(spark, chars):
    table, items = d.table(spark), passages(5)
    bench = spark.createDataFrame([*items, (9, None), (10, "")], "item_id long, text string")
    assert (c.pass_count(bench, chars) > 2) == (chars == 400)
    planted = table.limit(3).selectExpr("doc_id + 1000 as doc_id", f"concat('so it goes ', '{items[2][1]}', ' and on') as text")
    docs = table.select("doc_id", "text").unionByName(planted)
    found = c.find_contamination(docs, bench, chars).collect()
    assert sorted(r.doc_id or 0 for r in found) == sorted(r.doc_id or 0 for r in planted.collect()) and {r.item_id for r in found} == {2}
    assert c.drop_contaminated(docs, bench, chars).count() == docs.count() - 3
    assert c.find_contamination(docs, bench.filter("false"), chars).count() == 0
    assert c.drop_contaminated(d.empty(spark), bench, chars).count() == 0


def test_one_index_at_a_time(spark, monkeypatch):
    """Three passes: no moment has two indexes, and together they find what one pass finds."""
    items = passages(9)
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(i, f"so it goes {t} and on") for i, t in items] + [(99, "clean words only")], "doc_id long, text string")
    chars = sum(len(t) for _, t in items) // 3 + 1
    assert c.pass_count(bench, chars) == 3
    built, whole = [], c.index_of
    monkeypatch.setattr(c, "index_of", lambda *a: built.append(whole(*a)) or built[-1])
    many = sorted(map(tuple, c.find_contamination(docs, bench, chars).collect()))
    sizes = [sum(len(g.codes) for g in i.grams) for i in built]
    assert len(built) == 3 and max(sizes) < sum(sizes)
    assert many == sorted(map(tuple, c.find_contamination(docs, bench).collect())) and len({m[0] for m in many}) == 9
    assert [r.doc_id for r in c.drop_contaminated(docs, bench, chars).collect()] == [99]


def test_items_without_an_id(spark):
    """Rows and drop agree: what hits an item without an id is told and goes."""
    texts = [t for _, t in passages(3)]
    bench = spark.createDataFrame([(None, texts[0]), (None, texts[1]), (7, texts[2])], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"so it goes {t} and on") for i, t in enumerate(texts)] + [(9, "clean")], "doc_id long, text string")
    found = c.find_contamination(docs, bench).collect()
    assert sorted((r.doc_id, r.item_id or -1) for r in found) == [(0, -1), (1, -1), (2, 7)]
    assert [r.doc_id for r in c.drop_contaminated(docs, bench).collect()] == [9]


def test_grams_differ_only_by_chance():
    a = c._grams(c._codes("abcdefghijklmnopqrstuvwxyz" * 3), 12)
    assert np.array_equal(a[:26], a[26:52]) and len(set(a[:26].tolist())) == 26


def test_a_window_at_any_offset_is_found():
    rng = random.Random(11)
    items = passages()
    index = c.Index(items)
    for trial in range(200):
        item, passage = rng.choice(items)
        whole = c.normal(passage)
        a = rng.randrange(len(whole) - 64)
        edits = rng.randrange(4)
        quote = edited(rng, whole[a : a + 64], edits)
        before = d.prose(rng, 30) + " "
        hits = [h for h in index.search([before + quote + " " + d.prose(rng, 30)])[0] if h[0] == item]
        middle = len(before) + len(quote) // 2
        assert any(h[1] <= middle < h[2] and h[3] <= 3 for h in hits), (trial, a)


def test_hits_are_those_of_brute_force():
    rng = random.Random(12)
    items = [(i, d.prose(rng, 14)) for i in range(4)]
    assert all(len(c.normal(t)) >= 60 for _, t in items)
    index = c.Index(items)
    texts = []
    for _ in range(40):
        whole = c.normal(rng.choice(items)[1])
        a = rng.randrange(max(1, len(whole) - 50))
        texts.append(d.prose(rng, 6) + " " + edited(rng, whole[a : a + rng.randrange(50, 80)], rng.randrange(6)) + d.prose(rng, 6))
    for text, hits in zip(texts, index.search(texts)):
        for item, passage in items:
            whole, norm = c.normal(passage), c.normal(text)
            m = min(64, len(whole))
            near = any(plain_edits(whole[a : a + m], norm) <= 3 for a in range(len(whole) - m + 1))
            assert near == (item in {h[0] for h in hits}), (item, text)


def test_short_items_may_have_edits():
    rng = random.Random(13)
    for n in range(32, 60):
        item = d.prose(rng, 20, lines=False)[:n - 1].replace(" .", "..").rstrip().ljust(n, "z")
        assert len(c.normal(item)) == n
        index = c.Index([(7, item)])
        for edits in (0, 1, 3 * n // 64):
            text = d.prose(rng, 20) + " " + edited(rng, item, edits) + " " + d.prose(rng, 20)
            assert [h[0] for h in index.search([text])[0]] == [7], (n, edits)
    index = c.Index([(1, "What is the capital city of France?")])
    assert index.search(["so: what is the capital citty of france? x"])[0][0][0] == 1
    assert index.search(["so: what is the currency used in france? x"])[0] == []


def test_whole_items_are_whole_words():
    index = c.Index([(1, "yes"), (2, "42"), (3, "(a)"), (4, "日本")])
    texts = ["eyes yesterday 421 x42", "Yes.", "is it 42?", "f(a)b", "今日本語"]
    assert [[h[0] for h in hits] for hits in index.search(texts)] == [[], [1], [2], [3], [4]]
