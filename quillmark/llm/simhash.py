"""SimHash near-duplicates through a byte-position inverted index with count filtering."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_table, map_rows, materialise, small
from .components import components, merge

BYTES, BLOCKS = 8, 4
#: Fingerprints of one posting list beyond which it is split by further byte positions.
LONG_LIST = 2048
_ROWS = 1 << 15


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of word shingles, repeats included, as a signed integer; 0 without words."""
    parts = text.encode().lower().split() if text else []  # bytes.lower() changes A-Z only
    if not parts:
        return 0
    joined, n = b" ".join(parts), len(parts)
    if n < shingle:
        spans = [(0, len(joined))]
    else:
        sizes = np.fromiter(map(len, parts), np.int64, n)
        ends = np.cumsum(sizes + 1) - 1
        spans = list(zip((ends - sizes)[: n - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True))
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(spans), _ROWS):
        h = np.array([digest(joined[s:e], seed) for s, e in spans[at : at + _ROWS]], np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, BYTES), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(spans), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """Per row: ``doc_id, text_hash, fp`` (longs). A map without a shuffle."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    return map_rows(rows, ["doc_id", "text", "text_hash"], lambda: lambda ids, texts, hashes: (ids, hashes, [fingerprint(t, shingle, seed) for t in texts]), "doc_id long, text_hash long, fp long")


def local_classes(fps: np.ndarray, max_bits: int) -> np.ndarray:
    """Roots of a sorted posting list of distinct fingerprints (uint64), linked at ``max_bits`` or fewer differing bits.

    Pairs are tallied for equal bytes at the same position; those reaching
    ``8 - max_bits`` are verified.
    """
    n = len(fps)
    roots = np.arange(n)
    high = max(1, min(256, (1 << 19) // max(1, n)))
    for at in range(0, n, high):
        differ = fps[at : at + high, None] ^ fps[None, at:]
        tally = (differ[..., None].view(np.uint8) == 0).sum(axis=-1, dtype=np.uint8)
        i, j = np.nonzero(tally >= BYTES - max_bits)
        ok = (np.bitwise_count(differ[i, j]) <= max_bits) & (i < j)
        merge(roots, i[ok] + at, j[ok] + at)
    return roots


def _links_of_lists(lists: DataFrame, max_bits: int) -> DataFrame:
    """From posting lists ``fps array<long>``: edges ``a, b`` of a star for each class."""

    def run(batches):
        for batch in batches:
            column, a, b = batch.column(0), [], []
            values, offsets = column.values.to_numpy(zero_copy_only=False).view(np.uint64), column.offsets.to_numpy()
            for k in range(len(column)):
                fps = np.sort(values[offsets[k] : offsets[k + 1]])
                if len(fps) == 2:
                    if int(np.bitwise_count(fps[0] ^ fps[1])) <= max_bits:
                        a.append(fps[1:])
                        b.append(fps[:1])
                    continue
                roots = local_classes(fps, max_bits)
                moved = np.flatnonzero(roots != np.arange(len(fps)))
                a.append(fps[moved])
                b.append(fps[roots[moved]])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], names=["a", "b"])

    return lists.mapInArrow(run, "a long, b long")


def _mask(blocks, width: int) -> int:
    return sum(((1 << width) - 1) << (width * i) for i in blocks)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(distinct_fps: DataFrame, max_bits: int = 2, long_list: int = LONG_LIST) -> DataFrame:
    """Edges ``a, b`` that connect all fingerprints at ``max_bits`` (1 to 3) or fewer differing bits.

    ``max_bits`` differing bits spoil as many byte positions at most, so two
    such fingerprints share bytes at ``8 - max_bits`` positions or more. Taken
    in four blocks of two positions, ``4 - max_bits`` whole blocks stay equal:
    the postings of the index are all combinations of so many blocks. Posting
    lists longer than ``long_list`` are split by the other positions, of which
    all but ``max_bits`` must be equal too; with two bits 16 bits are then free,
    so that a list has 65,536 members at most. Each list gives a star for each
    of its classes, never its pairs.
    """
    if not 1 <= max_bits <= 3:
        raise ValueError("the index can guarantee matches for 1 to 3 bits")
    masks = [_mask(c, 16) for c in combinations(range(BLOCKS), BLOCKS - max_bits)]
    postings = distinct_fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("index", "key"))
    size = postings.groupBy("index", "key").count().where("count > 1")
    found = postings.join(size, ["index", "key"])
    short = found.where(F.col("count") <= long_list).groupBy("index", "key").agg(F.collect_list("fp").alias("fps"))
    out = _links_of_lists(short.select("fps"), max_bits)

    # the bytes that are left of a long list, in all ways in which max_bits of them may differ
    finer = [(i, _mask(set(range(BYTES)) - set(c), 8)) for i, m in enumerate(masks) for c in combinations([b for b in range(BYTES) if not m >> 8 * b & 1], max_bits)]
    rows = [F.struct(F.lit(i).alias("i"), F.lit(_signed(m)).alias("m")) for i, m in finer]
    split = (
        found.where(F.col("count") > long_list)
        .select("fp", "index", F.explode(F.array(*rows)).alias("x"))
        .where("x.i = index")
        .select("fp", "index", F.col("x.m").alias("mask"), F.col("fp").bitwiseAND(F.col("x.m")).alias("key"))
    )
    split = split.groupBy("index", "mask", "key").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    return out.unionByName(_links_of_lists(split.select("fps"), max_bits))


def _classified(docs: DataFrame, max_bits: int = 2, shingle: int = 3, seed: int = 42, long_list: int = LONG_LIST) -> DataFrame:
    """Per row: ``doc_id, text_hash, fp, component_id``."""
    prints = materialise(fingerprints(docs, shingle, seed), "fingerprints")
    first = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    edges = materialise(links(first.select("fp"), max_bits, long_list), "links")
    roots = components(edges).withColumnsRenamed({"node": "fp"})
    classes = first.join(roots, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = classes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_print = materialise(classes.join(least, "root").select("fp", "component_id"), "classes")
    drop_table(edges)
    return prints.join(of_print, "fp")


def near_duplicates(docs: DataFrame, **parameters) -> DataFrame:
    """Per row of ``docs``: ``doc_id, fingerprint`` (16 hex digits), ``component_id``.

    The component is the least doc_id reachable over links of fingerprints.
    Texts without words (null, empty) have fingerprint zero and are linked like
    any other. Null doc_ids get the least other id reachable, or null. Repeated
    rows come back each. Equal fingerprints are taken together before anything
    is joined, so a group of copies costs one row in the index. Parameters:
    ``max_bits`` 2, ``shingle`` 3, ``seed`` 42, ``long_list``.
    """
    return _classified(docs, **parameters).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` without all but the least doc_id of each component, columns unchanged.

    Of rows that repeat a doc_id with its text one is kept; rows with one
    doc_id and different texts are judged each by its text. Rows whose doc_id
    is null are kept: nothing tells which of them to keep.
    """
    return keep_least(docs, _classified(docs, **parameters))


def keep_least(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of ``docs`` that have their class's ``component_id``; classes: ``doc_id, text_hash, component_id`` per row."""
    later = materialise(classes.where("doc_id <> component_id").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "later")
    kept = docs.join(small(later), (docs["doc_id"] == later["_id"]) & (F.xxhash64(docs["text"]) == later["_hash"]), "left_anti")
    if classes.where("doc_id is not null").groupBy("doc_id", "text_hash").count().where("count > 1").limit(1).count():
        kept = kept.where("doc_id is not null").dropDuplicates(["doc_id", "text"]).unionByName(kept.where("doc_id is null"))
    return kept
