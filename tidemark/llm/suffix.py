"""Removal of passages that an earlier document holds, by suffix arrays.

A string of ``LENGTH`` bytes is removed wherever it also starts in a document with a smaller id. Suffix arrays of shards
find them: every string is sent to the shard that its smallest ``GRAM``-gram hash names, so equal strings meet. Only
strings around grams that occur in two documents with the same ``SIDE`` bytes before or after them are sent: of the bytes
of a string beside its gram, that many lie on one side. A shard builds suffix arrays by Larsson-Sadakane refinement and
common prefixes by Kasai's rule; a shard too large for one array is cut into pieces whose sorted strings are merged by
binary search.

Three passes over the texts, which are shuffled once: (1) which grams with one side occur in two documents, (2) the strings around
those grams, (3) removal. A task first drops what repeats among its own documents, so a passage that a third of all
documents share is sent once per chunk.

Defined results: a null text is empty; a document without an id comes after all others; rows with one id are one
document (nothing in them repeats "earlier"), each row is returned; texts shorter than ``LENGTH`` keep everything; an
empty table gives an empty result. Other columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

LENGTH, GRAM = 50, 20
SIDE = (LENGTH - GRAM + 1) // 2
#: Bytes of text that one task handles at a time, about, and bytes of one suffix array, at most.
CHUNK, PIECE = 4 << 20, 1 << 20
#: Bits that order grams and bits that tell grams with a side apart; equal bits of different grams only cost work.
ORDER_BITS, BITS = 36, 40
#: Bytes looked through together, so that a place fits beside the bits of the order.
SLICE = 1 << 27
_NULL = np.iinfo(np.int64).max
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def words_at(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as a little-endian number; zeros follow the end."""
    padded = np.concatenate((text, np.zeros(16, np.uint8)))
    out = np.empty(len(text) + 8, np.uint64)
    for shift in range(8):
        part = np.frombuffer(padded.data, "<u8", (len(padded) - shift) // 8, shift)
        out[shift::8] = part[: len(out[shift::8])]
    return out[: len(text)]


def gram_hashes(text: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each position."""
    n = len(text) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    w = words_at(text)
    h = w[:n] * _FACTOR
    h ^= h >> np.uint64(31)
    h += w[8 : 8 + n]
    h *= _FACTOR
    h ^= h >> np.uint64(29)
    h += w[16 : 16 + n] & np.uint64(0xFFFFFFFF)
    h *= _FACTOR
    h ^= h >> np.uint64(32)
    return h


def segments(text: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of consecutive windows with one gram, the leftmost of the smallest hashes, and none across documents:
    document number, first window, number of windows, place of the gram."""
    span = LENGTH - GRAM + 1
    n = len(text) - LENGTH + 1
    if n <= 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty
    change = np.zeros(n, bool)
    place = np.zeros(n, np.int64)
    low = np.uint64(64 - ORDER_BITS)
    for a in range(0, n, SLICE):
        z = min(n, a + SLICE)
        least = (hashes[a : z + span - 1] >> low << low) | np.arange(z + span - 1 - a, dtype=np.uint64)
        width = 1
        while width * 2 <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[: z - a], least[span - width : span - width + z - a])
        place[a:z] = a + (least & np.uint64((1 << (64 - ORDER_BITS)) - 1)).astype(np.int64)
    change[0] = True
    change[1:] = place[1:] != place[:-1]
    begin = ends - np.diff(ends, prepend=0)
    late = ends - LENGTH + 1  # first start that is too late
    change[begin[begin < n]] = True
    change[late[(late > begin) & (late < n)]] = True
    first = np.nonzero(change)[0]
    count = np.diff(np.append(first, n))
    doc = np.searchsorted(ends, first, "right")
    whole = first + LENGTH <= ends[doc]
    return doc[whole], first[whole], count[whole], place[first[whole]]


def sided(hashes: np.ndarray, place: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """For grams at ``place`` in documents from ``begin`` to ``end``: hash of the gram with the ``SIDE`` bytes before it,
    whether there are so many, and the same for the bytes after it."""
    gram = hashes[place]
    left, right = place - SIDE >= begin, place + GRAM + SIDE <= end
    before = hashes[np.where(left, place - SIDE, place)]
    after = hashes[np.where(right, place + SIDE, place)]
    mix = lambda a, b: ((a * _FACTOR ^ b) * _FACTOR) >> np.uint64(64 - BITS)
    return mix(before, gram), left, mix(after ^ np.uint64(1), gram), right


def gather(text: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The given stretches of the text, one after the other."""
    if not len(first):
        return np.zeros(0, np.uint8)
    move = np.repeat(first - (np.cumsum(size) - size), size)
    return text[move + np.arange(len(move))]


def suffix_array(text: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Positions in the order of the suffixes' first ``depth`` bytes at least, by Larsson-Sadakane refinement: sorted by
    five bytes first, then groups that still hold several positions are sorted by the rank so many bytes further on, which
    doubles what is compared each time. Holds up to 2**21 bytes, so that two ranks and a position share one number."""
    n = len(text)
    assert n <= 1 << 21
    padded = np.concatenate((text, np.zeros(5, np.uint8))).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(5):
        key = key << np.uint64(8) | padded[k : k + n]
    key = np.sort(key << np.uint64(24) | np.arange(n, dtype=np.uint64))
    order = (key & np.uint64((1 << 24) - 1)).astype(np.int64)
    head = key >> np.uint64(24)
    new = np.ones(n, bool)
    new[1:] = head[1:] != head[:-1]
    start = np.maximum.accumulate(np.where(new, np.arange(n), 0))  # rank of a group is its first place
    rank = np.zeros(n + 1, np.int64)
    rank[order] = start + 1  # 0 is the end of the text
    done = 5
    alone = new & np.append(new[1:], True)
    open_ = np.nonzero(~alone)[0]
    while done < depth and len(open_):
        at = order[open_]
        key = (
            (rank[at].astype(np.uint64) << np.uint64(42)) | (rank[np.minimum(at + done, n)].astype(np.uint64) << np.uint64(21))
            | at.astype(np.uint64)
        )
        key.sort()
        at = (key & np.uint64((1 << 21) - 1)).astype(np.int64)
        order[open_] = at
        head = key >> np.uint64(21)
        new = np.ones(len(at), bool)
        new[1:] = head[1:] != head[:-1]
        first = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
        rank[at] = open_[first] + 1
        open_ = open_[~(new & np.append(new[1:], True))]
        done *= 2
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int = LENGTH, chains: int = 64) -> np.ndarray:
    """Length, ``most`` at most, of the common prefix of each suffix in ``order`` and the one before it. Kasai's rule, a
    position has at most one byte less in common than the position before it, is followed along runs of ``chains``
    positions, all runs at once."""
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    words = np.concatenate((words_at(text), np.zeros(most + 8, np.uint64)))
    common = np.zeros(n, np.int64)
    starts = np.arange(0, n, chains)
    length = np.zeros(len(starts), np.int64)
    for step in range(min(chains, n)):
        at = starts + step
        at = at[at < n]
        length = np.maximum(length[: len(at)] - 1, 0)
        other = before[at]
        live = np.nonzero((other >= 0) & (length < most))[0]
        length[other < 0] = 0
        while len(live):
            i, j, l = at[live], other[live], length[live]
            x = words[i + l] ^ words[j + l]
            same = np.where(x == 0, 8, np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)) // 8).astype(np.int64)
            # Not beyond the end of the text.
            grown = np.minimum(l + same, np.minimum(most, n - np.maximum(i, j)))
            length[live] = grown
            live = live[(same == 8) & (grown == l + 8) & (grown < most)]
        common[at] = length
    return common[order]


def equal_to_earlier(text: np.ndarray, hashes: np.ndarray, first: np.ndarray, size: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which stretches (``LENGTH`` to ``2 * LENGTH - GRAM`` bytes) equal, byte for byte, one with a smaller id."""
    out = np.zeros(len(first), bool)
    if not len(first):
        return out
    tail = first + size - GRAM
    sign = size.astype(np.uint64)
    for k in range(0, 2 * LENGTH - GRAM, GRAM):
        sign = (sign ^ hashes[np.minimum(first + k, tail)]) * _FACTOR + np.uint64(k + 1)
    order = np.lexsort((ids, sign))
    lead = np.append(True, sign[order][1:] != sign[order][:-1])
    leader = order[np.maximum.accumulate(np.where(lead, np.arange(len(order)), 0))]
    later = (ids[order] > ids[leader]) & (size[order] == size[leader])
    a, b = order[later], leader[later]
    for i in range(0, len(a), 1 << 16):
        s = size[a[i : i + (1 << 16)]]
        x, y = (gather(text, first[q[i : i + (1 << 16)]], s) for q in (a, b))
        out[a[i : i + (1 << 16)]] = np.logical_and.reduceat(x == y, np.cumsum(s) - s)
    return out


def _strings(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The strings of ``LENGTH`` bytes from the given positions, comparable as bytes."""
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(text, LENGTH)[at]).view(f"V{LENGTH}").ravel()


def repeated(text: np.ndarray, ends: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Positions whose string of ``LENGTH`` bytes lies in its stretch and also starts in a stretch with a smaller id.
    ``ends`` are the ends of the stretches of ``text``."""
    pieces = []
    cut = [0]
    for k in range(len(ends)):
        if ends[k] - (ends[cut[-1] - 1] if cut[-1] else 0) > PIECE and k > cut[-1]:
            cut.append(k)
    for a, z in zip(cut, [*cut[1:], len(ends)]):
        begin = int(ends[a - 1]) if a else 0
        part = text[begin : int(ends[z - 1])]
        stop = ends[a:z] - begin
        owner = np.searchsorted(stop, np.arange(len(part)), "right")
        inside = np.arange(len(part)) + LENGTH <= stop[owner]
        order = suffix_array(part)
        new = common_prefixes(part, order) < LENGTH
        new[:1] = True
        group = np.cumsum(new) - 1
        real = inside[order]
        order, group = order[real], group[real]
        if not len(order):
            continue
        head = np.ones(len(order), bool)
        head[1:] = group[1:] != group[:-1]
        first = np.nonzero(head)[0]
        group = np.cumsum(head) - 1
        least = np.minimum.reduceat(ids[a:z][owner[order]], first)
        pieces.append((begin, order, group, ids[a:z][owner[order]], least, first, part))
    found = [np.zeros(0, np.int64)]
    many = len(pieces) > 1
    sorted_strings = [_strings(p[6], p[1][p[5]]).view(f"S{LENGTH}") for p in pieces] if many else []
    for n, (begin, order, group, own, least, first, _) in enumerate(pieces):
        least = least.copy()
        for m, other in enumerate(pieces if many else []):
            if m != n:
                # Merge of two sorted lists by binary search.
                place = np.searchsorted(sorted_strings[m], sorted_strings[n])
                hit = np.nonzero(place < len(sorted_strings[m]))[0]
                hit = hit[sorted_strings[m][place[hit]] == sorted_strings[n][hit]]
                least[hit] = np.minimum(least[hit], other[4][place[hit]])
        found.append(begin + order[own > least[group]])
    return np.concatenate(found)


def _runs(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of consecutive sorted numbers: first and last."""
    new = np.ones(len(at), bool)
    new[1:] = at[1:] != at[:-1] + 1
    first = np.nonzero(new)[0]
    return at[first], at[np.append(first[1:], len(at)) - 1] if len(at) else at


def _packed(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(a.nbytes for a in arrays)], "<i8").tobytes()
    return zstandard.compress(head + b"".join(a.tobytes() for a in arrays), 1)


def _unpacked(data: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.decompress(data)
    sizes = np.frombuffer(raw, "<i8", len(kinds) + 1)[1:]
    out, at = [], 8 * (len(kinds) + 1)
    for size, kind in zip(sizes.tolist(), kinds):
        out.append(np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


class Chunk:
    """The documents of one chunk in a fixed order, as one array of bytes."""

    def __init__(self, table: pa.Table, search: bool = True):
        texts = table["text"].cast(pa.large_binary()).to_pylist()
        ids = [_NULL if k is None else k for k in table["doc_id"].to_pylist()]
        order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i]))
        self.ids = np.array([ids[i] for i in order], np.int64)
        self.texts = [texts[i] for i in order]
        self.ends = np.cumsum([len(t) for t in self.texts]).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(self.texts), np.uint8)

        self.begins = self.ends - np.diff(self.ends, prepend=0)
        if not search:
            return
        self.hashes = gram_hashes(self.bytes)
        self.doc, self.first, self.count, self.place = segments(self.bytes, self.ends, self.hashes)

    def offers(self) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, ...]]:
        """The different hashes of grams with one side in ascending order, whether two documents of the chunk hold them,
        and the hashes of each segment."""
        sides = sided(self.hashes, self.place, self.begins[self.doc], self.ends[self.doc])
        before, left, after, right = sides
        h = np.concatenate((before[left], after[right]))
        d = np.concatenate((self.ids[self.doc[left]], self.ids[self.doc[right]]))
        order = np.lexsort((d, h))
        h, d = h[order], d[order]
        first = np.nonzero(np.append(True, h[1:] != h[:-1]))[0] if len(h) else np.zeros(0, np.int64)
        last = np.append(first[1:], len(h)) - 1
        return h[first], d[first] != d[last] if len(first) else np.zeros(0, bool), sides


def _range(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each hash: ranges of values, so that sorted hashes of one shard lie close together."""
    return ((hashes >> np.uint64(BITS - 20)) * np.uint64(shards) >> np.uint64(20)).astype(np.int64)


def _close(sorted_numbers: np.ndarray) -> np.ndarray:
    """Differences of sorted numbers as bytes, the low bytes of all of them first: the zeros above compress away."""
    return np.ascontiguousarray(np.diff(sorted_numbers, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T)


def _from_close(raw: np.ndarray) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(raw.reshape(8, -1).T).view("<u8").ravel(), dtype=np.uint64)


def _split(shards: np.ndarray) -> list[tuple[int, int, int]]:
    """``(shard, from, to)`` of sorted shard numbers."""
    if not len(shards):
        return []
    first = np.nonzero(np.append(True, shards[1:] != shards[:-1]))[0]
    return list(zip(shards[first].tolist(), first.tolist(), [*first[1:].tolist(), len(shards)]))


_ROW = "shard long, chunk long, data binary"
_KIND = pa.schema([("shard", pa.int64()), ("chunk", pa.int64()), ("data", pa.binary())])


def _table(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else ([], [], []), _KIND)], schema=_KIND)


def remove_repeats(docs: DataFrame, chunk_bytes: int = CHUNK) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (bytes) for each row of ``docs(doc_id, text)``."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text")
    )
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // chunk_bytes))
    shards = parts
    # One shuffle of the texts serves all three passes.
    texts = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)))

    def offer(key: tuple, table: pa.Table) -> pa.Table:
        grams, twice, _ = Chunk(table).offers()
        rows = []
        for s, a, z in _split(_range(grams, shards)):
            rows.append((s, key[0].as_py(), _packed(_close(grams[a:z]), np.packbits(twice[a:z]))))
        return _table(rows)

    def common(key: tuple, table: pa.Table) -> pa.Table:
        got = [_unpacked(d, "u1", "u1") for d in table["data"].to_pylist()]
        hashes = [_from_close(g) for g, _ in got]
        twice = [np.unpackbits(t, count=len(h)).astype(bool) for h, (_, t) in zip(hashes, got)]
        every = np.sort(np.concatenate(hashes))
        again = every[1:][every[1:] == every[:-1]]
        rows = []
        for c, h, t in zip(table["chunk"].to_pylist(), hashes, twice):
            place = np.minimum(np.searchsorted(again, h), max(0, len(again) - 1))
            wanted = t | (again[place] == h) if len(again) else t
            if wanted.any():
                rows.append((key[0].as_py(), c, _packed(np.packbits(wanted), np.array([len(h)], "<i8"))))
        return _table(rows)

    def strings(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _table([])
        chunk = Chunk(left)
        grams, _, (before, has_before, after, has_after) = chunk.offers()
        wanted = np.zeros(len(grams), bool)
        place = {s: (a, z) for s, a, z in _split(_range(grams, shards))}
        for s, data in zip(right["shard"].to_pylist(), right["data"].to_pylist()):
            bits, n = _unpacked(data, "u1", "<i8")
            a, z = place[s]
            wanted[a:z] = np.unpackbits(bits, count=int(n[0])).astype(bool)
        chosen = grams[wanted]
        if not len(chosen):
            return _table([])
        among = lambda x: chosen[np.minimum(np.searchsorted(chosen, x), len(chosen) - 1)] == x
        take = (has_before & among(before)) | (has_after & among(after))
        doc, first, count = chunk.doc[take], chunk.first[take], chunk.count[take]
        hashes = chunk.hashes
        h = hashes[chunk.place[take]]
        size = count + LENGTH - 1
        # Equal strings of later documents of the chunk need not travel: what they repeat is here.
        local = equal_to_earlier(chunk.bytes, hashes, first, size, chunk.ids[doc])
        start = first - chunk.begins[doc]
        shard = (h % np.uint64(shards)).astype(np.int64)
        order = np.lexsort((start, doc, local, shard))
        rows = []
        for s, x, z in _split(shard[order]):
            mine = order[x:z]
            sent = mine[~local[mine]]
            known = mine[local[mine]]
            rows.append((s, key[0].as_py(), _packed(
                doc[sent].astype("<i4"), start[sent].astype("<i8"), size[sent].astype("u1"), h[sent].astype("<u8"),
                chunk.ids[doc[sent]].astype("<i8"), gather(chunk.bytes, first[sent], size[sent]),
                doc[known].astype("<i4"), start[known].astype("<i8"), size[known].astype("u1"),
            )))
        return _table(rows)

    def match(key: tuple, table: pa.Table) -> pa.Table:
        got = [_unpacked(d, "<i4", "<i8", "u1", "<u8", "<i8", "u1", "<i4", "<i8", "u1") for d in table["data"].to_pylist()]
        chunks = table["chunk"].to_pylist()
        doc, start, size, h, ids = (np.concatenate([g[k] for g in got]) for k in range(5))
        text = np.concatenate([g[5] for g in got])
        source = np.repeat(np.arange(len(got)), [len(g[0]) for g in got])
        at_source = np.append(0, np.cumsum([len(g[0]) for g in got]))
        size = size.astype(np.int64)
        ends = np.cumsum(size)
        # What equals a string of an earlier document is repeated as a whole; the arrays need not hold it.
        same = equal_to_earlier(text, gram_hashes(text), ends - size, size, ids)
        rest = np.nonzero(~same)[0]
        # Strings of one hash lie together; arrays hold whole hashes as far as they fit.
        order = rest[np.argsort(h[rest], kind="stable")]
        hits: list[np.ndarray] = []
        sorted_h = h[order]
        edge = np.append(np.nonzero(np.append(True, sorted_h[1:] != sorted_h[:-1]))[0], len(order))
        upto = np.append(0, np.cumsum(size[order]))
        a = 0
        while len(order) and a < len(edge) - 1:
            b = int(np.searchsorted(upto[edge], upto[edge[a]] + PIECE, "right")) - 1
            b = min(max(b, a + 1), len(edge) - 1)
            lot = order[edge[a] : edge[b]]
            stretch = gather(text, ends[lot] - size[lot], size[lot])
            stop = np.cumsum(size[lot])
            at = repeated(stretch, stop, ids[lot])
            k = np.searchsorted(stop, at, "right")
            hits.append(np.column_stack((source[lot[k]], doc[lot[k]], start[lot[k]] + at - (stop[k] - size[lot[k]]))))
            a = b
        found = np.concatenate(hits) if hits else np.zeros((0, 3), np.int64)
        found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
        rows = []
        for n, (c, g) in enumerate(zip(chunks, got)):
            x, z = np.searchsorted(found[:, 0], [n, n + 1])
            d, s = found[x:z, 1], found[x:z, 2]
            # Windows that follow each other are one stretch.
            new = np.append(True, (d[1:] != d[:-1]) | (s[1:] != s[:-1] + 1)) if len(d) else np.zeros(0, bool)
            f = np.nonzero(new)[0]
            l = np.append(f[1:], len(d))[: len(f)] - 1
            mine = np.nonzero(same[at_source[n] : at_source[n + 1]])[0] + at_source[n]
            if len(d) or len(g[6]) or len(mine):
                rows.append((key[0].as_py(), c, _packed(
                    np.concatenate((d[f], g[6], doc[mine])).astype("<i4"),
                    np.concatenate((s[f], g[7], start[mine])).astype("<i8"),
                    np.concatenate((s[l] - s[f] + LENGTH, g[8].astype(np.int64), size[mine])).astype("<i8"),
                )))
        return _table(rows)

    def remove(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = Chunk(left, search=False) if left.num_rows else None
        out: list[tuple] = []
        if chunk is not None:
            change = np.zeros(len(chunk.bytes) + 1, np.int32)
            begins = chunk.begins
            for data in right["data"].to_pylist():
                doc, start, size = _unpacked(data, "<i4", "<i8", "<i8")
                at = begins[doc] + start
                np.add.at(change, at, 1)
                np.add.at(change, at + size, -1)
            gone = np.cumsum(change[:-1]) > 0
            rise = gone.copy()
            rise[1:] &= ~gone[:-1]
            rise[begins[begins < len(gone)]] |= gone[begins[begins < len(gone)]]
            removed, spans = np.append(0, np.cumsum(gone)), np.append(0, np.cumsum(rise))
            for k, (b, e) in enumerate(zip(begins.tolist(), chunk.ends.tolist())):
                n = int(removed[e] - removed[b])
                kept = chunk.bytes[b:e][~gone[b:e]].tobytes() if n else chunk.texts[k]
                out.append((None if chunk.ids[k] == _NULL else int(chunk.ids[k]), e - b, n, int(spans[e] - spans[b]), kept))
        kinds = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())]
        columns = zip(*out) if out else [[]] * len(kinds)
        return pa.table([pa.array(c, t) for c, (_, t) in zip(columns, kinds)], schema=pa.schema(kinds))

    offered = texts.groupBy("chunk").applyInArrow(offer, _ROW)
    wanted = offered.groupBy("shard").applyInArrow(common, _ROW)
    sent = texts.groupBy("chunk").cogroup(wanted.groupBy("chunk")).applyInArrow(strings, _ROW)
    found = sent.groupBy("shard").applyInArrow(match, _ROW)
    return texts.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(
        remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )
