"""Benchmark decontamination by spaced-seed hashing with substitution-tolerant verification."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: Token positions that each mask compares; it ignores those between. In any 10 tokens with 2 substitutions,
#: and in any 13 with 3, one of these masks fits between the substitutions.
MASKS = ((0, 1, 2, 3, 5), (0, 2, 6, 7, 8), (0, 1, 2, 7, 8), (0, 4, 6, 8, 9))
#: UTF-8 bytes of benchmark text that one pass over the documents looks for; a larger benchmark takes more passes.
BLOCK_BYTES = 8 << 20
#: Characters of documents that are hashed together.
SLICE_CHARS = 1 << 21

_ALNUM = b"0123456789abcdefghijklmnopqrstuvwxyz"
_TO_WORDS = bytes(b if b >= 0x80 or b in _ALNUM else 0x20 for b in range(256))


#: Ranges of scripts that put no spaces between words, and of punctuation beyond ASCII.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_MARKS = re.compile("[\u00a0-\u00bf\u2000-\u206f\u3000-\u303f\uff00-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65]")


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters and digits; each character by itself in scripts without spaces."""
    if not text:
        return []
    text = text.lower()
    if not text.isascii():
        text = _UNSPACED.sub(r" \g<0> ", _MARKS.sub(" ", text))
    return text.encode().translate(_TO_WORDS).split()


@dataclass(frozen=True)
class Rule:
    """An overlap counts from ``min_tokens`` aligned tokens (or all of a shorter item), of which ``min_share`` are equal, ends included."""

    min_tokens: int = 13
    min_share: float = 0.8


def _short_masks(n: int, min_share: float) -> list[tuple[int, ...]]:
    """Masks for an item of ``n`` tokens that the others don't fit into: all its tokens but as many as may differ."""
    differ = min(int(n * (1 - min_share) + 1e-9), max(0, n - 2))
    return [tuple(sorted(set(range(n)) - set(c))) for c in combinations(range(1, n - 1), differ)]


class Index:
    """Seed hashes of a block of benchmark items."""

    def __init__(self, items: list[tuple[int, str | None]], rule: Rule, masks=MASKS):
        self.rule, self.masks = rule, masks
        self.number: dict[bytes, int] = {}
        self.items: list[tuple[int, np.ndarray]] = []
        reach = max(m[-1] for m in masks) + 1
        by_mask: dict[tuple[int, ...], list] = {}
        r = np.random.RandomState(7)
        self.weights = r.randint(1, 1 << 62, 64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
        for item_id, text in items:
            ids = np.array([self.number.setdefault(t, len(self.number) + 1) for t in tokens(text)], np.int64)
            if not len(ids):
                continue
            self.items.append((item_id, ids))
            own = masks if len(ids) >= reach else _short_masks(len(ids), rule.min_share)
            for m in own:
                n = len(ids) - m[-1]
                h = self.hashes(ids, m, np.arange(n))
                by_mask.setdefault(m, []).append((h, np.full(n, len(self.items) - 1), np.arange(n)))
        self.seeds = {}
        for m, parts in by_mask.items():
            h, item, at = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(h, kind="stable")
            self.seeds[m] = (h[order], item[order], at[order])

    def hashes(self, ids: np.ndarray, mask: tuple[int, ...], at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), np.uint64)
        for k, o in enumerate(mask):
            out += ids[at + o].astype(np.uint64) * self.weights[k]
        return out

    def scan(self, texts: list[str | None]) -> list[list[tuple[int, int, int, int, int]]]:
        """Per text: overlaps (item_id, doc_start, item_start, n_tokens, n_equal), in token positions."""
        out: list[list] = []
        part, size = [], 0
        for t in texts:
            part.append(t)
            size += len(t or "")
            if size >= SLICE_CHARS:
                out += self._scan(part)
                part, size = [], 0
        return out + self._scan(part)

    def _scan(self, texts: list[str | None]) -> list[list]:
        found: list[list] = [[] for _ in texts]
        if not self.items:
            return found
        gap = max(m[-1] for m in self.seeds) + 1
        get, ids, starts, sizes = self.number.get, [], [], []
        for t in texts:
            own = [get(w, 0) for w in tokens(t)]
            starts.append(len(ids))
            sizes.append(len(own))
            ids += own
            ids += [0] * gap  # so that no seed reaches from one text into the next
        ids, starts = np.array(ids, np.int64), np.array(starts, np.int64)
        known = ids > 0
        hits = []
        for m, (h, item, at) in self.seeds.items():
            n = len(ids) - m[-1]
            if n <= 0:
                continue
            full = known[:n].copy()
            for o in m[1:]:
                full &= known[o : o + n]
            place = np.flatnonzero(full)
            own = self.hashes(ids, m, place)
            low = np.searchsorted(h, own, "left")
            count = np.searchsorted(h, own, "right") - low
            some = count > 0
            place, low, count = place[some], low[some], count[some]
            if len(place):
                k = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                doc = np.searchsorted(starts, np.repeat(place, count), "right") - 1
                hits.append(np.stack([doc, item[k], np.repeat(place, count) - starts[doc] - at[k]], axis=1))
        if hits:  # each diagonal of a text and an item once
            for doc, item, shift in np.unique(np.concatenate(hits), axis=0).tolist():
                item_id, want = self.items[item]
                low, high = max(0, -shift), min(len(want), sizes[doc] - shift)
                base = starts[doc] + shift
                overlap = self._longest(ids[base + low : base + high] == want[low:high])
                if overlap and overlap[1] - overlap[0] >= min(self.rule.min_tokens, len(want)):
                    a, b, equal = overlap
                    found[doc].append((item_id, shift + low + a, low + a, b - a, equal))
        return found

    def _longest(self, equal: np.ndarray) -> tuple[int, int, int] | None:
        """The longest stretch, equal at both ends, with enough equal tokens; the first among equals."""
        at = np.flatnonzero(equal)
        if not len(at):
            return None
        # at[i]..at[j] holds j - i + 1 equal tokens of at[j] - at[i] + 1: enough if gain[j] - gain[i] >= share - 1
        share = self.rule.min_share
        gain = np.arange(len(at)) - share * at
        best = (0, 0)
        lowest = np.minimum.accumulate(gain)
        for j in range(len(at)):
            i = int(np.searchsorted(-lowest[: j + 1], -(gain[j] - share + 1 + 1e-9)))
            if i <= j and at[j] - at[i] > at[best[1]] - at[best[0]]:
                best = (i, j)
        i, j = best
        return int(at[i]), int(at[j]) + 1, j - i + 1


def _blocks(benchmark: DataFrame, rule: Rule, block_bytes: int, named: bool) -> Iterator[Index]:
    """Indexes of the benchmark, a block of bounded size at a time. If overlaps are to be ``named``, rows without an id are left out; else equal texts are taken once."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id") if named else F.lit(0).cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.where("item_id is not null") if named else items.distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes) or 1
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield Index([tuple(r) for r in part.orderBy("item_id", "text").collect()], rule)


_OVERLAP = "doc_id long, item_id long, doc_start long, item_start long, n_tokens long, n_equal long"


def overlaps(docs: DataFrame, benchmark: DataFrame, rule: Rule = Rule(), block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every verified overlap: ``doc_id, item_id, doc_start, item_start, n_tokens, n_equal``.

    One row for each document, item and alignment: the longest stretch of
    aligned tokens that satisfies ``rule`` around a seed hit. Benchmark rows without an id are left out, as nothing could name them. The documents are
    mapped once for each block of the benchmark, without a shuffle; only a
    block, of bounded size, is sent to the executors. Null and empty texts and
    items have no overlaps; repeated documents give theirs each, and items with
    equal texts are reported each.
    """
    spark, out = docs.sparkSession, None
    small_batches(spark)
    for index in _blocks(benchmark, rule, block_bytes, named=True):
        sent = spark.sparkContext.broadcast(index)

        def run(batches, sent=sent):
            for batch in batches:
                ids = batch.column(0).to_pylist()
                rows = [(doc_id, *x) for doc_id, own in zip(ids, sent.value.scan(batch.column(1).to_pylist()), strict=True) for x in own]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=[p.split()[0] for p in _OVERLAP.split(", ")])

        part = docs.select("doc_id", "text").mapInArrow(run, _OVERLAP)
        out = part if out is None else out.unionByName(part)
    return out


def without_overlaps(docs: DataFrame, benchmark: DataFrame, rule: Rule = Rule(), block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the rows that overlap any benchmark item, those without an id included; columns unchanged.

    Documents with null or empty text are kept, and repeated rows each judged alike; an empty benchmark drops nothing.
    """
    small_batches(docs.sparkSession)
    for index in _blocks(benchmark, rule, block_bytes, named=False):
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, sent=sent):
            for batch in batches:
                yield batch.filter(pa.array([not x for x in sent.value.scan(batch.column("text").to_pylist())], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
