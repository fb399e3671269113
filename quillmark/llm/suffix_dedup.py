"""Removal of byte strings that documents repeat, by suffix sorting with bucket-pointer refinement.

A string of ``length`` bytes is removed where it also starts in a document with
a smaller doc_id. Sorting all suffixes of a corpus moves many times its size,
so they are sorted in independent parts, chosen so that no match is lost:

1. Each window of ``length`` bytes has a minimiser, the least hash of its
   24-byte grams. Runs of windows with the same minimiser are *stretches*.
   Equal windows have equal minimisers. Batches of documents tell which
   minimisers they have, five bytes each, and learn which other batches have.
2. Stretches with a minimiser found in two documents are sent to the part of
   that minimiser, once a batch with their least doc_id. The part's distinct
   stretches are suffix-sorted: buckets of 8-byte grams are refined by sorting
   on the bucket pointers of later offsets, each pass using those that the last
   one refined, until buckets are equal over ``length`` bytes. The least doc_id
   of each bucket goes back to the batches.
3. Each batch marks the bytes covered by windows with a smaller doc_id.

A batch speaks once for any number of copies, so a passage of a third of all
documents costs a row for each batch. A minimiser whose stretches are too many
because they differ around a common passage is dealt out by whole windows.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import BATCH_BYTES, PART_BYTES, as_table, batched, free_name, parts_for, released, total_bytes
from .batches import pack as _pack
from .batches import unpack as _unpack
from .common import materialise

GRAM = 24
#: Stretches of a minimiser, as counted by batches, beyond which its windows are dealt out one by one.
HOT_STRETCHES = 50_000
#: Bytes of stretches sorted at once, if a lot of minimisers hasn't more; a larger part is sorted by lots.
SORT_BYTES = 2 << 20
_LOTS = 64
#: Windows of a piece of a long text, and bytes that are hashed together: few enough to stay in a processor's cache.
_PIECE, _SLICE = 1 << 15, 1 << 16
_POS_BITS = np.uint64(20)
_LAST = (1 << 63) - 1


class Params(NamedTuple):
    length: int
    parts: int
    hot: int
    sort_bytes: int


class Stretches(NamedTuple):
    """Runs of windows with one minimiser: document place, first byte, windows, minimiser."""

    doc: np.ndarray
    start: np.ndarray
    windows: np.ndarray
    gram: np.ndarray


def _grams8(a: np.ndarray) -> np.ndarray:
    """Big-endian numbers of the 8 bytes from each place."""
    x = a.astype(np.uint64)
    for width in (1, 2, 4):
        x = (x[:-width] << np.uint64(8 * width)) | x[width:]
    return x


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (width - span)], x[width - span :]) if span < width else x


def _cut(text: bytes, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place, windows and minimiser of the stretches of joined strings that end at ``ends``; the leftmost least gram counts."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    a = np.frombuffer(text, np.uint8)
    if len(a) < length:
        return none
    g = _grams8(a)
    h = _mixed(_mixed(g[: len(a) - GRAM + 1] * np.uint64(0x9E3779B97F4A7C15)) + _mixed(g[8 : len(a) - GRAM + 9] * np.uint64(0xC2B2AE3D27D4EB4F)) + g[16:] * np.uint64(0x165667B19E3779F9))
    key = (h >> _POS_BITS << _POS_BITS) | np.arange(len(h), dtype=np.uint64)
    at = (_sliding_min(key, length - GRAM + 1) & np.uint64((1 << 20) - 1)).astype(np.int64)
    valid = np.ones(len(at) + 1, bool)  # windows that reach past the end of a string aren't any
    for e in ends.tolist():
        valid[max(0, e - length + 1) : e] = False
    valid[-1] = False
    fresh = valid[:-1].copy()
    fresh[1:] &= (at[1:] != at[:-1]) | ~valid[:-2]
    first = np.flatnonzero(fresh)
    if not len(first):
        return none
    stop = np.flatnonzero(np.concatenate([fresh[1:] | ~valid[1:-1], [True]]) & valid[:-1]) + 1
    return first, stop - first, h[at[first]]


def stretches(texts: list[bytes], length: int) -> Stretches:
    """All windows of all texts; long texts are cut between windows, not between bytes."""
    out, part, size = [], [], 0

    def flush() -> None:
        ends = np.cumsum([len(x[2]) for x in part])
        first, windows, gram = _cut(b"".join(x[2] for x in part), ends, length)
        own = np.searchsorted(ends, first, "right")
        doc, base = (np.array([x[k] for x in part], np.int64) for k in (0, 1))
        out.append((doc[own], first - (ends - [len(x[2]) for x in part])[own] + base[own], windows, gram))

    for k, text in enumerate(texts):
        for base in range(0, len(text) - length + 1, _PIECE):
            piece = text[base : base + _PIECE + length - 1]
            if size + len(piece) > _SLICE:
                flush()
                part, size = [], 0
            part.append((k, base, piece))
            size += len(piece)
    if part:
        flush()
    return Stretches(*(np.concatenate(c) for c in zip(*out, strict=True))) if out else Stretches(*(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64)))


_BITS = 21  # of a place in what is sorted at once: two pointers and a place fill a number of 63 bits


def _grouped(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in the order of (high, low), which are places themselves; the sorted ``high``; where (high, low) changes.

    Up to 2**21 of them are sorted as numbers that carry their place, which is faster than sorting places.
    """
    n = len(high)
    if n == 0 or max(int(high.max()), int(low.max()), n) >> _BITS:
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        return order, high, np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])])[:n]
    x = np.sort((high << 2 * _BITS) | (low << _BITS) | np.arange(n))
    pair = x >> _BITS
    return x & ((1 << _BITS) - 1), pair >> _BITS, np.concatenate([[True], pair[1:] != pair[:-1]])


def _first_buckets(g: np.ndarray) -> np.ndarray:
    """The pointer of each place's bucket of equal grams: the rank of the bucket's first."""
    n = len(g)
    if n >> 32:
        order = np.argsort(g)
    else:
        place, mask = np.arange(n, dtype=np.uint64), np.uint64(0xFFFFFFFF)
        order = (np.sort((g << np.uint64(32)) | place) & mask).astype(np.int64)
        order = order[(np.sort((g[order] & ~mask) | place) & mask).astype(np.int64)]
    by_order = g[order]
    fresh = np.concatenate([[True], by_order[1:] != by_order[:-1]])[:n]
    pointer = np.empty(n, np.int64)
    pointer[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    return pointer


def equal_windows(text: bytes, windows: np.ndarray, length: int, q: int = 8) -> np.ndarray:
    """Bucket of each window of ``length`` bytes: equal for equal windows, in the order of their bytes.

    Places get the buckets of their ``q``-grams (a bucket's pointer is the rank
    of its first suffix). A pass of depth d sorts the members of buckets with
    more than one by the pointer of the place d bytes further, or fewer on the
    last pass, which doubles the depth; pointers refined so are used by the next.
    """
    n = len(text)
    pointer = _first_buckets(_grams8(np.frombuffer(text + bytes(q - 1), np.uint8)))
    reach = np.full(n, -1, np.int64)
    reach[windows] = windows + length
    left = np.maximum.accumulate(reach) - np.arange(n)  # bytes that windows still hold from a place on
    depth = q
    while depth < length:
        step = min(depth, length - depth)
        many = np.bincount(pointer, minlength=n) > 1
        place = np.flatnonzero(many[pointer] & (left >= depth + step))
        if len(place):
            order, old, fresh = _grouped(pointer[place], pointer[place + step])
            index = np.arange(len(place))
            head = np.maximum.accumulate(np.where(np.concatenate([[True], old[1:] != old[:-1]]), index, 0))
            own = np.maximum.accumulate(np.where(fresh, index, 0))
            pointer[place[order]] = old + own - head
        depth += step
    return pointer[windows]


class Batch:
    """The documents of a batch, least doc_id first, nulls last."""

    def __init__(self, table: pa.Table, p: Params):
        ids = table.column("doc_id").to_numpy(zero_copy_only=False) if not table.column("doc_id").null_count else np.array([_LAST if x is None else x for x in table.column("doc_id").to_pylist()], np.int64)
        self.order = np.argsort(ids, kind="stable")
        self.ids = ids[self.order].astype(np.int64)
        column = table.column("text")
        self.texts = [(column[int(i)].as_py() or "").encode() for i in self.order]
        self.p = p
        self.s = stretches(self.texts, p.length)
        self.grams, self.inverse = np.unique(self.s.gram, return_inverse=True)
        self.part = ((self.grams >> np.uint64(40)) % np.uint64(p.parts)).astype(np.int64)

    def told(self) -> Iterator[tuple[int, bytes]]:
        """For each part: its minimisers, five bytes each, and how many stretches have them."""
        count = np.bincount(self.inverse, minlength=len(self.grams)).astype(np.uint32)
        by_part = np.argsort(self.part, kind="stable")
        for own in np.split(by_part, np.flatnonzero(np.diff(self.part[by_part])) + 1):
            if len(own):
                yield int(self.part[own[0]]), _pack(np.ascontiguousarray(self.grams[own].view(np.uint8).reshape(-1, 8)[:, :5]), count[own])

    def candidates(self, replies: list[tuple[int, bytes]]) -> tuple[list[tuple[int, int, int, bytes]], dict[int, dict[bytes, tuple[int, int]]]]:
        """What may repeat: (document, first byte, part, stretch), and for each part the least doc_id and the lot of its distinct stretches."""
        low = np.full(len(self.grams), len(self.ids))
        high = np.full(len(self.grams), -1)
        np.minimum.at(low, self.inverse, self.s.doc)
        np.maximum.at(high, self.inverse, self.s.doc)
        shared, hot = low < high, np.zeros(len(self.grams), bool)
        for part, blob in replies:
            own = np.flatnonzero(self.part == part)
            a, b = (np.unpackbits(np.frombuffer(x, np.uint8), count=len(own)).astype(bool) for x in _unpack(blob))
            shared[own] |= a
            hot[own] |= b
        lots = ((self.grams >> np.uint64(32)) % np.uint64(_LOTS)).astype(np.int64)
        found, length, texts, ids = [], self.p.length, self.texts, self.ids.tolist()
        least: defaultdict[int, dict[bytes, tuple[int, int]]] = defaultdict(dict)
        chosen = np.flatnonzero(shared[self.inverse])
        gram = self.inverse[chosen]
        columns = (self.s.doc[chosen], self.s.start[chosen], self.s.windows[chosen], self.part[gram], lots[gram], hot[gram])
        for doc, start, n, part, lot, many in zip(*(c.tolist() for c in columns), strict=True):  # in the order of doc_ids
            if many:
                for at in range(start, start + n):
                    piece = texts[doc][at : at + length]
                    h = xxhash.xxh64_intdigest(piece)
                    found.append((doc, at, part := h % self.p.parts, piece))
                    least[part].setdefault(piece, (ids[doc], h >> 58))
            else:
                piece = texts[doc][start : start + n + length - 1]
                found.append((doc, start, part, piece))
                least[part].setdefault(piece, (ids[doc], lot))
        return found, least


def _part_of_gram(batch_ids: list[int], blobs: list[bytes], hot: int) -> list[bytes]:
    """For each batch that told of minimisers: which of them other batches have too, and which have too many stretches."""
    told = [_unpack(b) for b in blobs]
    sizes = [len(x[1]) // 4 for x in told]
    raw = np.zeros((sum(sizes), 8), np.uint8)
    raw[:, :5] = np.frombuffer(b"".join(x[0] for x in told), np.uint8).reshape(-1, 5)
    _, inverse, times = np.unique(raw.view(np.uint64).ravel(), return_inverse=True, return_counts=True)
    many = np.bincount(inverse, weights=np.frombuffer(b"".join(x[1] for x in told), np.uint32)) > hot
    out, at = [], 0
    for n in sizes:
        own = inverse[at : at + n]
        out.append(_pack(np.packbits(times[own] > 1), np.packbits(many[own])))
        at += n
    return out


def _least_of_windows(pieces: list[bytes], least: np.ndarray, lots: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """The least doc_id of each window of each stretch, and where each stretch's windows begin. Equal windows are in one lot."""
    sizes = np.array([len(x) for x in pieces], np.int64)
    n = sizes - p.length + 1
    begin = np.concatenate([[0], np.cumsum(n)])
    out = np.empty(begin[-1], np.int64)
    of_lot = np.bincount(lots, sizes, _LOTS)
    turn = ((np.cumsum(of_lot) - of_lot) // p.sort_bytes).astype(np.int64)[lots]
    order = np.argsort(turn, kind="stable")
    groups = np.split(order, np.flatnonzero(np.diff(turn[order])) + 1)
    for own in groups:
        text = b"".join([pieces[i] for i in own])
        base = np.cumsum(sizes[own]) - sizes[own]
        each = np.repeat(np.arange(len(own)), n[own])
        step = np.arange(len(each)) - np.repeat(np.cumsum(n[own]) - n[own], n[own])
        bucket = equal_windows(text, base[each] + step, p.length)
        low = np.full(len(text), _LAST)
        np.minimum.at(low, bucket, least[own][each])
        out[begin[own][each] + step] = low[bucket]
    return out, begin


def _part_of_stretches(blobs: list[bytes], p: Params) -> list[bytes | None]:
    """For each batch: runs of windows (stretch, first window, windows) that start in a document before its own."""
    number: dict[bytes, int] = {}
    own, docs, lots = [], [], np.zeros(0, np.int64)
    for blob in blobs:
        sizes, text, ids, lot = _unpack(blob)
        ends = np.cumsum(np.frombuffer(sizes, np.uint8).astype(np.int64)).tolist()
        own.append(np.array([number.setdefault(text[a:b], len(number)) for a, b in zip([0, *ends[:-1]], ends, strict=True)], np.int64))
        docs.append(np.frombuffer(ids, np.int64))
        lots = np.concatenate([lots, np.zeros(len(number) - len(lots), np.int64)])
        lots[own[-1]] = np.frombuffer(lot, np.uint8)
    least = np.full(len(number), _LAST)
    for k, ids in zip(own, docs, strict=True):
        np.minimum.at(least, k, ids)
    low, begin = _least_of_windows(list(number), least, lots, p)
    out: list[bytes | None] = []
    for k, ids in zip(own, docs, strict=True):
        n = begin[k + 1] - begin[k]
        each = np.repeat(np.arange(len(k)), n)
        step = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
        at = np.flatnonzero(low[begin[k][each] + step] < ids[each])
        if not len(at):
            out.append(None)
            continue
        fresh = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (each[at[1:]] != each[at[:-1]])])
        first = np.flatnonzero(fresh)
        out.append(_pack(each[at[first]].astype(np.uint32), step[at[first]].astype(np.uint8), np.diff(np.append(first, len(at))).astype(np.uint8)))
    return out


def _spans(batch: Batch, gram_replies: list, stretch_replies: list) -> list[list[list[int]]]:
    """Per document of the batch: the maximal runs of bytes to remove."""
    found, least = batch.candidates(gram_replies)
    earlier: dict[bytes, list[tuple[int, int]]] = {}
    for part, blob in stretch_replies:
        order = sorted(least[part])
        which, first, n = (np.frombuffer(x, t).tolist() for x, t in zip(_unpack(blob), (np.uint32, np.uint8, np.uint8), strict=True))
        for w, f, c in zip(which, first, n, strict=True):
            earlier.setdefault(order[w], []).append((f, c))
    ranges: list[list[tuple[int, int]]] = [[] for _ in batch.texts]
    for doc, start, part, piece in found:
        if least[part][piece][0] < batch.ids[doc]:
            ranges[doc].append((start, start + len(piece)))
        else:
            for first, n in earlier.get(piece, ()):
                ranges[doc].append((start + first, start + first + n + batch.p.length - 1))
    out = []
    for own in ranges:
        merged: list[list[int]] = []
        for a, b in sorted(own):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        out.append(merged)
    return out


def _rest(text: bytes, spans: list[list[int]]) -> bytes:
    if not spans:
        return text
    return b"".join(text[a:b] for a, b in zip([0, *(s[1] for s in spans)], [*(s[0] for s in spans), len(text)], strict=True))


def _removed(docs: DataFrame, finish, schema: str, length: int, batch_bytes: int, part_bytes: int, hot: int, sort_bytes: int) -> DataFrame:
    """The three exchanges; ``finish(table, batch, spans)`` makes the result of a batch."""
    if not GRAM + 8 <= length <= 139:  # a stretch then has under 256 bytes
        raise ValueError(f"length must be from {GRAM + 8} to 139")
    total = total_bytes(docs)
    p = Params(length, parts_for(total, part_bytes), hot, sort_bytes)
    column = free_name(docs)
    table = batched(docs, batch_bytes, total, column)
    lean = table.select(F.col(column).alias("_batch"), "doc_id", "text")
    row = "part long, _batch long, blob binary"

    def out(rows: list[tuple]) -> pa.Table:
        return as_table(rows, {"part": pa.int64(), "_batch": pa.int64(), "blob": pa.binary()})

    @released
    def tell(t: pa.Table) -> pa.Table:
        key = t.column("_batch")[0].as_py()
        return out([(part, key, blob) for part, blob in Batch(t, p).told()])

    @released
    def meet(t: pa.Table) -> pa.Table:
        ids, part = t.column("_batch").to_pylist(), t.column("part")[0].as_py()
        return out([(part, b, x) for b, x in zip(ids, _part_of_gram(ids, t.column("blob").to_pylist(), p.hot), strict=True)])

    @released
    def send(t: pa.Table, replies: pa.Table) -> pa.Table:
        if not t.num_rows:
            return out([])
        key = t.column("_batch")[0].as_py()
        _, least = Batch(t, p).candidates(list(zip(replies.column("part").to_pylist(), replies.column("blob").to_pylist(), strict=True)))
        rows = []
        for part, own in least.items():
            order = sorted(own)
            ids, lots = zip(*map(own.__getitem__, order), strict=True)
            rows.append((part, key, _pack(np.array([len(x) for x in order], np.uint8), b"".join(order), np.array(ids, np.int64), np.array(lots, np.uint8))))
        return out(rows)

    @released
    def sort(t: pa.Table) -> pa.Table:
        part = t.column("part")[0].as_py()
        found = _part_of_stretches(t.column("blob").to_pylist(), p)
        return out([(part, b, x) for b, x in zip(t.column("_batch").to_pylist(), found, strict=True) if x is not None])

    @released
    def end(t: pa.Table, replies: pa.Table) -> pa.Table:
        if not t.num_rows:
            return finish(t, None, None)
        kinds = [[(part, blob) for part, blob, k in zip(*(replies.column(c).to_pylist() for c in ("part", "blob", "kind")), strict=True) if k == kind] for kind in (1, 2)]
        batch = Batch(t.select(["doc_id", "text"]), p)
        return finish(t, batch, _spans(batch, *kinds))

    grams = materialise(lean.groupBy("_batch").applyInArrow(tell, row).groupBy("part").applyInArrow(meet, row), "grams")
    ranges = materialise(lean.groupBy("_batch").cogroup(grams.groupBy("_batch")).applyInArrow(send, row).groupBy("part").applyInArrow(sort, row), "ranges")
    replies = grams.withColumn("kind", F.lit(1)).unionByName(ranges.withColumn("kind", F.lit(2)))
    return table.groupBy(column).cogroup(replies.groupBy("_batch")).applyInArrow(end, schema)


def removed_digest(docs: DataFrame, length: int = 50, batch_bytes: int = BATCH_BYTES, part_bytes: int = PART_BYTES, hot: int = HOT_STRETCHES, sort_bytes: int = SORT_BYTES) -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans`` (the removed runs as first byte, end, ...).

    Null and empty texts have no bytes; texts under ``length`` bytes lose none.
    Rows that repeat a doc_id aren't before each other, so copies under one id
    stay; null doc_ids count as larger than any other and equal to each other.
    Other columns are neither read nor returned.
    """
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>"
    kinds = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string(), "spans": pa.list_(pa.int64())}

    def finish(t, batch, spans):
        rows = []
        if batch is not None:
            for doc_id, text, own in zip(batch.ids.tolist(), batch.texts, spans, strict=True):
                rest = _rest(text, own)
                rows.append((None if doc_id == _LAST else doc_id, len(text), len(text) - len(rest), len(own), hashlib.sha256(rest).hexdigest(), [x for s in own for x in s]))
        cols = zip(*rows, strict=True) if rows else [[] for _ in kinds]
        return pa.table({n: pa.array(c, k) for (n, k), c in zip(kinds.items(), cols, strict=True)})

    return _removed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), finish, schema, length, batch_bytes, part_bytes, hot, sort_bytes)


def without_repeats(docs: DataFrame, length: int = 50, batch_bytes: int = BATCH_BYTES, part_bytes: int = PART_BYTES, hot: int = HOT_STRETCHES, sort_bytes: int = SORT_BYTES) -> DataFrame:
    """``docs`` with repeated bytes taken out of ``text``, all other columns unchanged.

    Bytes of a character that was removed in part go too. Rows of which nothing
    but white space is left are dropped, unless nothing was removed from them.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def finish(t, batch, spans):
        t = t.drop_columns([t.schema.names[0]])
        if batch is None:
            return t
        new: list[str | None] = t.column("text").to_pylist()
        keep = [True] * len(new)
        for place, text, own in zip(batch.order.tolist(), batch.texts, spans, strict=True):
            if own:
                new[place] = _rest(text, own).decode("utf-8", "ignore")
                keep[place] = bool(new[place].strip())
        return t.set_column(t.schema.get_field_index("text"), "text", pa.array(new, pa.string())).filter(pa.array(keep, pa.bool_()))

    return _removed(docs, finish, schema, length, batch_bytes, part_bytes, hot, sort_bytes)
