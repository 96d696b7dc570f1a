"""Benchmark decontamination: regions of a text that are within an edit budget of a benchmark passage.

Texts are compared in lower case with runs of white space as one space. A window is any ``WINDOW`` characters of a
benchmark item, from any offset. By the q-gram lemma a region within ``k`` edits of a window of ``m`` characters shares
at least ``m - q + 1 - k q`` q-grams with it, all on ``k + 1`` neighbouring diagonals; matching q-grams are counted in
overlapping diagonal bands by their place in the item, windows with enough are kept, and a banded alignment of each has
the last word.

Defined results: null and empty texts have no hits; an item shorter than a window is one window, from ``Q * (EDITS + 2)``
characters on with all edits, from ``SHORTEST`` on with edits in proportion to its length and grams of ``SHORT_Q``; items
shorter than ``SHORTEST`` characters are looked up exactly, as whole words (an empty or null item is left out); repeated
items are reported under each id, a repeated document row gets its hits again, an empty table gives no rows. Other
columns pass through untouched.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import saved, values

#: Characters of a q-gram, of a window, and between the starts of windows (all are looked for); edits allowed in a window.
Q, WINDOW, EDITS = 12, 64, 3
#: Characters from which an item may have edits, and of a q-gram of items too short for ``Q``.
SHORTEST, SHORT_Q = 32, 10
#: Windows that are aligned together.
ALIGNED = 4096
#: Characters of benchmark text that one pass over the documents looks for; more text takes more passes.
PASS_CHARS = 8_000_000
#: Characters of documents that a task looks through together.
LOT_CHARS = 250_000
GAP = "\x00"


def normal(text: str | None) -> str:
    return " ".join((text or "").replace(GAP, " ").lower().split())


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _grams(codes: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of the q-gram that starts at each position."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    x = codes.astype(np.uint64)
    h, width = x, 1
    # Doubling: a gram of 2w characters from two of w.
    out, at = None, 0
    factor = np.uint64(0x9E3779B97F4A7C15)
    while True:
        if q >> (width.bit_length() - 1) & 1:
            part = h[at : at + n]
            out = part.copy() if out is None else out * (factor ^ np.uint64(width)) + part
            at += width
        if width * 2 > q:
            break
        h = h[:-width] * (factor + np.uint64(2 * width)) + h[width:]
        h ^= h >> np.uint64(29)
        width *= 2
    out ^= out >> np.uint64(32)
    return out * factor


class Grams:
    """The q-grams of items, by place, and the windows of the items that a text comes near. Places count through all
    items, one after another."""

    def __init__(self, items: list[tuple[int, np.ndarray]], q: int, window: int, edits: list[int]):
        self.q, self.ids = q, [i for i, _ in items]
        length = np.array([len(c) for _, c in items], np.int64)
        self.codes = np.concatenate([c for _, c in items])
        self.begin = np.cumsum(length) - length
        self.of = np.repeat(np.arange(len(items), dtype=np.int32), length)
        self.size = np.minimum(window, length)  # characters of a window, by item
        self.edits = np.array(edits, np.int64)
        self.last = self.begin + length - self.size  # where the last window begins
        self.need = self.size - q + 1 - self.edits * q
        self.least, self.reach = int(self.need.min()), int((self.size + self.edits).max())
        h = _grams(self.codes, q)
        place = np.nonzero(self.of[: len(h)] == self.of[q - 1 :])[0]  # none reaches into the next item
        h = h[place]
        order = np.argsort(h, kind="stable")
        self.hash, self.place = h[order], place[order]
        # A bit table in front of the exact search, with 32 places per gram.
        self.bits = max(16, int(max(1, len(h)) * 32 - 1).bit_length())
        self.table = np.zeros(1 << self.bits, bool)
        self.table[(self.hash >> np.uint64(64 - self.bits)).astype(np.int64)] = True

    def hits(self, codes: np.ndarray) -> list[tuple[int, int, int, int]]:
        item, band, start = self.near(codes)
        if not len(start):
            return []
        size, k = self.size[item], self.edits[item]
        low = band * (k + 1)
        edits, end = self.unmoved(codes, start, low, size, 2 * int(k.max() + 1))
        for n in np.unique(k):
            for m in np.unique(size[k == n]):
                rest = np.nonzero((k == n) & (size == m) & (edits > 1))[0]
                for part in (rest[x : x + ALIGNED] for x in range(0, len(rest), ALIGNED)):
                    edits[part], end[part] = self.moved(codes, start[part], low[part], int(m), int(n))
        good = np.nonzero(edits <= k)[0]
        if not len(good):
            return []
        item, band, start, edits, end, size = (x[good] for x in (item, band, start, edits, end, size))
        # Windows at neighbouring places are one stretch.
        first = np.ones(len(good), bool)
        first[1:] = (item[1:] != item[:-1]) | (band[1:] != band[:-1]) | (start[1:] != start[:-1] + 1)
        first = np.nonzero(first)[0]
        a = np.maximum(0, np.minimum.reduceat(end - size, first))
        z = np.minimum(len(codes), np.maximum.reduceat(end, first))
        e = np.maximum.reduceat(edits, first)
        return [(self.ids[i], *x) for i, *x in zip(item[first].tolist(), a.tolist(), z.tolist(), e.tolist())]

    def near(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Item, band and place of each window that shares enough q-grams with the text in the band, in this order."""
        none = (np.zeros(0, np.int64),) * 3
        g = _grams(codes, self.q)
        at = np.nonzero(self.table[(g >> np.uint64(64 - self.bits)).astype(np.int64)])[0]
        if len(at) < self.least:
            return none
        low = np.searchsorted(self.hash, g[at], "left")
        high = np.searchsorted(self.hash, g[at], "right")
        real = high > low
        at, low, high = at[real], low[real], high[real]
        # A region is at most a window and its edits long: stretches of text with too few grams go.
        ahead = np.searchsorted(at, at + self.reach, "left") - np.arange(len(at))
        dense = np.zeros(len(at) + 1, np.int64)
        start = np.nonzero(ahead >= self.least)[0]
        np.add.at(dense, start, 1)
        np.add.at(dense, start + ahead[start], -1)
        keep = np.cumsum(dense[:-1]) > 0
        at, low, high = at[keep], low[keep], high[keep]
        if not len(at):
            return none
        times = high - low
        pos = np.repeat(at, times)
        place = self.place[np.repeat(low - np.concatenate(([0], np.cumsum(times)[:-1])), times) + np.arange(times.sum())]
        item = self.of[place].astype(np.int64)
        # Bands of 2k + 2 diagonals, one beginning every k + 1: any k + 1 neighbours lie in one of them.
        band = (pos - place) // (self.edits[item] + 1)
        band = np.concatenate((band, band - 1))
        place, item = np.concatenate((place, place)), np.concatenate((item, item))
        order = np.lexsort((place, band, item))
        place, band, item = place[order], band[order], item[order]
        once = np.ones(len(place), bool)
        once[1:] = (place[1:] != place[:-1]) | (band[1:] != band[:-1])
        place, band, item = place[once], band[once], item[once]
        # A window has enough where the gram that makes it enough is not too far ahead.
        i = np.arange(len(place))
        i = i[i + self.need[item] <= len(place)]
        j = i + self.need[item[i]] - 1
        span = self.size[item[i]] - self.q
        enough = (item[j] == item[i]) & (band[j] == band[i]) & (place[j] - place[i] <= span)
        i, j, span = i[enough], j[enough], span[enough]
        item, band = item[i], band[i]
        first, last = np.maximum(self.begin[item], place[j] - span), np.minimum(place[i], self.last[item])
        same = (item[1:] == item[:-1]) & (band[1:] == band[:-1])
        first[1:] = np.where(same, np.maximum(first[1:], last[:-1] + 1), first[1:])  # each window once
        n = np.maximum(0, last - first + 1)
        return np.repeat(item, n), np.repeat(band, n), np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())

    def unmoved(self, codes, start, low, size, diagonals: int) -> tuple[np.ndarray, np.ndarray]:
        """Least number of characters that differ on one of the diagonals from ``low`` on, and where that stretch ends."""
        # Windows at neighbouring places lie in a run; their characters are compared once per diagonal.
        new = np.ones(len(start), bool)
        new[1:] = (start[1:] != start[:-1] + 1) | (low[1:] != low[:-1]) | (size[1:] != size[:-1])
        head = np.nonzero(new)[0]
        long = np.diff(np.append(head, len(start))) + size[head] - 1
        base = np.cumsum(long) - long
        place = np.repeat(start[head] - base, long) + np.arange(long.sum())
        mine, at = self.codes[place], place + np.repeat(low[head], long)
        here = (base - head)[np.cumsum(new) - 1] + np.arange(len(start))
        edits, end = np.full(len(start), 1 << 14, np.int64), start + low + size
        for d in range(diagonals):
            p = at + d
            differs = (p < 0) | (p >= len(codes)) | (codes[np.clip(p, 0, len(codes) - 1)] != mine)
            total = np.concatenate(([0], np.cumsum(differs)))
            n = total[here + size] - total[here]
            less = n < edits
            edits[less], end[less] = n[less], (start + low + size)[less] + d
        return edits, end

    def moved(self, codes, start, low, m: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Least edits of many windows of ``m`` characters and where those stretches end: the paths of up to ``k`` edits that touch
        their bands, which start free."""
        steps = np.arange(2 * (k + 1) + 2 * k)
        at = (start + low - k)[:, None] + steps
        row = np.zeros(at.shape, np.int64)
        far = np.full((len(start), 1), 1 << 14)
        for i in range(m):
            p = at + i
            # What is beyond the text differs from everything.
            differs = (p < 0) | (p >= len(codes)) | (codes[np.clip(p, 0, len(codes) - 1)] != self.codes[start + i][:, None])
            best = np.minimum(row + differs, np.concatenate((row[:, 1:], far), 1) + 1)
            row = np.minimum.accumulate(best - steps, 1) + steps
        end = row.argmin(1)
        return row[np.arange(len(end)), end], start + low - k + end + m


class Index:
    """What to look for of a bounded set of benchmark texts."""

    def __init__(self, items: list[tuple[int, str]], q: int = Q, window: int = WINDOW, edits: int = EDITS):
        self.edits, self.nameless = edits, frozenset()
        texts = [(i, normal(t)) for i, t in items]
        full = q * (edits + 2)
        self.short = [(i, t) for i, t in texts if t and len(t) < min(SHORTEST, full)]
        some = [(i, _codes(t)) for i, t in texts if SHORTEST <= len(t) < full]
        most = [(i, _codes(t)) for i, t in texts if len(t) >= full]
        self.grams = []
        if most:
            self.grams.append(Grams(most, q, window, [edits] * len(most)))
        if some:
            self.grams.append(Grams(some, SHORT_Q, window, [max(1, edits * len(c) // window) for _, c in some]))

    def search(self, texts: Iterable[str | None], n: int | None = None) -> list[list[tuple[int, int, int, int]]]:
        """Per text ``(item, start, end, edits)`` for each item found, in code points of the original text, end
        exclusive: the whole stretch over which windows of the item match; edits are those of the worst window in it."""
        out: list[list[tuple[int, int, int, int]]] = []
        # Texts are looked through together, so far apart that no match reaches from one into the next.
        gap, lot, size = GAP * (self.edits + 1), [], 0
        n = len(texts) if n is None else n
        for t in chain(texts, (None,)):
            lot.append((t or "", normal(t)))
            size += len(lot[-1][1])
            if size >= LOT_CHARS or len(out) + len(lot) > n:
                begins = np.cumsum([0] + [len(n) + len(gap) for _, n in lot])
                mine: list[list] = [[] for _ in lot]
                for item, a, z, e in self.hits(gap.join(n for _, n in lot)):
                    k = int(np.searchsorted(begins, (a + z) // 2, "right")) - 1
                    mine[k].append((item, max(0, a - int(begins[k])), z - int(begins[k]), e))
                out += [regions(t, h) for (t, _), h in zip(lot, mine)]
                lot, size = [], 0
        return out[:n]

    def hits(self, norm: str) -> list[tuple[int, int, int, int]]:
        found = [(i, a, a + len(s), 0) for i, s in self.short for a in _occurrences(norm, s)]
        codes = _codes(norm)
        return found + [h for g in self.grams if len(codes) >= g.q for h in g.hits(codes)]


def regions(text: str, hits: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Hits in the normal form of a text, joined per item and given as whole words of the text itself."""
    if not hits:
        return []
    # Where each word begins and ends, in the normal form and in the text.
    spans = [m.span() for m in re.finditer(r"[^\s\x00]+", text)]
    low = np.cumsum([0] + [len(text[a:b].lower()) + 1 for a, b in spans])
    out: dict[int, list[list[int]]] = {}
    for item, a, z, e in sorted(hits):
        runs = out.setdefault(item, [])
        if runs and a <= runs[-1][1] + 1:
            runs[-1][1], runs[-1][2] = max(runs[-1][1], z), max(runs[-1][2], e)
        else:
            runs.append([a, z, e])
    place = lambda p: min(len(spans) - 1, max(0, int(np.searchsorted(low, p, "right")) - 1))
    return [
        (item, spans[place(a)][0], spans[place(max(a, z - 1))][1], e) for item, runs in out.items() for a, z, e in runs
    ]


#: Scripts without blanks between words (Thai to Lao, Burmese, Khmer, kana, ideographs).
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def _within_word(a: str, b: str) -> bool:
    """Whether no word ends between two neighbouring characters."""
    return all((c == "_" or unicodedata.category(c)[0] in "LMN") and not _UNSPACED.match(c) for c in (a, b))


def _occurrences(text: str, part: str) -> list[int]:
    """Where the part stands in the text as whole words."""
    found, at = [], text.find(part)
    while at >= 0:
        z = at + len(part)
        if not (at and _within_word(text[at - 1], part[0]) or z < len(text) and _within_word(part[-1], text[z])):
            found.append(at)
        at = text.find(part, at + 1)
    return found


HIT = "array<struct<item_id:long,start:int,end:int,edits:int>>"


def pass_count(benchmark: DataFrame, pass_chars: int = PASS_CHARS) -> int:
    """Passes in which a benchmark is looked for: ``pass_chars`` characters each, about."""
    total = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    return max(1, -(-total // pass_chars))


def index_of(benchmark: DataFrame, part: int = 0, parts: int = 1) -> Index:
    """The index of one of the passes; rows are dealt out by their hash. Items without an id have numbers of their own, which
    ``nameless`` tells."""
    rows = benchmark.filter("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    mine = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).orderBy("item_id", "text")
    items = [(r.item_id, r.text) for r in mine.collect()]  # bounded by the number of passes
    free = min((i for i, _ in items if i is not None), default=0)
    numbers = [i if i is not None else free - 1 - k for k, (i, _) in enumerate(items)]
    index = Index([(n, t) for n, (_, t) in zip(numbers, items)])
    index.nameless = frozenset(n for n, (i, _) in zip(numbers, items) if i is None)
    return index


def contamination(text: Column | str, index: Index) -> Column:
    """Hits of a text column in an index: array of (item_id, start, end, edits)."""

    @F.arrow_udf(HIT)
    def run(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("edits", pa.int32())]))
        found = index.search(values(texts), len(texts))
        return pa.array([
            [{"item_id": None if i in index.nameless else i, "start": a, "end": z, "edits": e} for i, a, z, e in hits] for hits in found
        ], kind)

    return run(text)


def find_contamination(docs: DataFrame, benchmark: DataFrame, pass_chars: int = PASS_CHARS) -> DataFrame:
    """One row per document row, benchmark item and matching stretch: ``doc_id, item_id, start, end, edits``. A benchmark of many
    passes goes through the documents once for each; the hits of a pass are stored before the next index is built."""
    parts, out = pass_count(benchmark, pass_chars), None
    for p in range(parts):
        hits = docs.select("doc_id", contamination("text", index_of(benchmark, p, parts)).alias("hits"))
        # The outer form keeps Spark from computing the hits once more to leave out empty ones.
        own = hits.select("doc_id", F.inline_outer("hits")).filter("end is not null")
        own = saved(own, "hits") if parts > 1 else own
        out = own if out is None else out.unionByName(own)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, pass_chars: int = PASS_CHARS) -> DataFrame:
    """Documents without a hit. What a pass leaves is stored for the next one."""
    parts = pass_count(benchmark, pass_chars)
    for p in range(parts):
        docs = docs.filter(F.size(contamination("text", index_of(benchmark, p, parts))) == 0)
        docs = saved(docs, "clean") if p + 1 < parts else docs
    return docs
