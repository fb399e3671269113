"""Near copies by word shingles: long SimHash fingerprints propose pairs by shared bytes, exact Jaccard similarity decides.

Texts of the same set of shingles are one *node*. A node has 512 bits of SimHash
and stands in a posting list for each of 128 combinations of byte positions
(512 combinations of three bytes for very many nodes). Members of a list are
compared by their first 256 bits (128 in the first pass), then by all 512, then by their shingles.

A group of copies would give all its pairs, so links are found in two passes.
In the first, each member of a list tells its nearest neighbour, and each node's
nearest pair and all likely ones are verified; what they connect has one *root*. In the second, the lists tell
which roots have near members: a forest of roots, never pairs of nodes. Nodes whose
roots this connects are one *near class*. Its nodes meet with their shingles, and all
that are near and not connected yet are compared where they meet; again only a forest is told. A large
class is cut into pieces that meet two by two, except those of its largest root with each other. So what the
first pass looks at (neighbours in a long list, lists dealt out) decides how much work there is and
not what is found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import pack, released, unpack
from .common import drop_table, map_rows, materialise, small, small_batches
from .components import components, merge
from .simhash import keep_least

BYTES = 64
#: Byte positions of a posting, from each position on (modulo 64): two bytes up to ``WIDE`` nodes, three beyond.
TWO = ((0, 1), (0, 5))
THREE = tuple((0, a, b) for a, b in ((1, 3), (5, 11), (2, 9), (7, 20), (4, 17), (10, 25), (6, 29), (12, 31)))
#: More of them for sets of at most ``SMALL`` shingles, whose bits differ more.
MORE = {2: ((0, 2), (0, 3), (0, 7)), 3: tuple((0, a + 1, b + 2) for _, a, b in THREE)}
SMALL = 16
WIDE = 1 << 26
#: Bits that may differ among the first 128, the first 256 and all 512 of two fingerprints, and how many more if a set has under ``TINY``
#: shingles: the mean at a similarity of 0.8 (20, 39, 78; 24, 48, 95 for 4 of 5 shingles) and 4.5 deviations (3.6 for tiny sets in the first).
FIRST_BITS, NEAR_BITS, ALL_BITS = 40, 68, 120
TINY, TINY_NEAR, TINY_ALL = 10, 8, 16
#: Bits of all 512 up to which the first pass verifies a pair even if it isn't a node's nearest.
LIKELY_BITS = 84
#: Neighbours of a member in its list that the first pass looks at.
REACH = 512
#: Members of a list beyond which it is dealt out.
HOT_LIST = 20_000
#: Members of a list beyond which classes of it are grown one after another.
LONG_LIST = 256
#: Bytes of shingles in a piece of a near class, at least and at most, and those of a part of pieces that meet.
PIECE, PART_BYTES = (1 << 17, 1 << 20), 4 << 20
#: Postings of a part.
PART_ROWS = 500_000
_MUL = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) for i in range(64)], np.uint64)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles; a text of fewer words is one shingle, one without words has none."""
    parts = text.encode().lower().split() if text else []  # bytes.lower() changes A-Z only
    if not parts:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, parts), np.uint64, len(parts))
    n, k = max(1, len(parts) - size + 1), min(size, len(parts))
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out += h[i : i + n] * _POWERS[i]
    out = np.sort(_mixed(out))
    return out[np.concatenate([[True], out[1:] != out[:-1]])]


def long_fingerprint(own: np.ndarray) -> np.ndarray:
    """SimHash of ``BYTES`` bytes of a set of shingles."""
    counts, words = np.zeros(8 * BYTES, np.int64), np.arange(1, BYTES // 8 + 1, dtype=np.uint64) * _MUL
    for at in range(0, len(own), 255):  # so many ones fit a byte
        bits = np.unpackbits(_mixed(own[at : at + 255, None] + words).view(np.uint8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * counts > len(own), bitorder="little")


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = np.sort(np.concatenate([a, b]))
    common = int((both[1:] == both[:-1]).sum())
    return common / max(1, len(both) - common)


def _prints(docs: DataFrame, size: int) -> DataFrame:
    """Per row ``doc_id, text_hash, key, size, print``; the key stands for the set of shingles, of which there are ``size``."""

    def work(ids, texts, hashes):
        sets = [shingles(t, size) for t in texts]
        keys = [xxhash.xxh64_intdigest(s.tobytes()) - (1 << 63) for s in sets]
        return ids, hashes, keys, [len(s) for s in sets], [long_fingerprint(s).tobytes() if len(s) else None for s in sets]

    return map_rows(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")), ["doc_id", "text", "text_hash"], lambda: work, "doc_id long, text_hash long, key long, size long, print binary")


def _slots(prints: list[bytes], combos: tuple, number: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The posting lists of each fingerprint (nodes x combinations and positions), and its first 256 bits (n x 4)."""
    fps = np.frombuffer(b"".join(prints), np.uint8).reshape(-1, BYTES)
    out, width = [], 8 * len(combos[0])
    for d, positions in enumerate(combos, number):
        value = np.zeros(fps.shape, np.int64)
        for p in positions:
            value = value << 8 | np.roll(fps, -p, axis=1)
        out.append((np.arange(d * BYTES, (d + 1) * BYTES) << width) + value)
    return np.concatenate(out, axis=1), np.ascontiguousarray(fps[:, :32]).view(np.int64)


def _hot_lists(nodes: DataFrame, combos: tuple, hot: int, of_roots: np.ndarray | None = None) -> dict[int, tuple[int, int]]:
    """Lists that are dealt out: ``{list: (pieces, root)}``; with ``of_roots`` only the members of these roots count, the root being the most frequent.

    A list with a five-hundredth of all nodes has it in some batch too, so batches tell what they have
    that often, and there are at most ``500 x combinations`` such lists.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            slots, _ = _slots(batch.column(0).to_pylist(), combos)
            root = batch.column(1).to_numpy() if of_roots is not None else np.zeros(len(slots), np.int64)
            for r in of_roots.tolist() if of_roots is not None else (0,):
                value, n = np.unique(slots[root == r], return_counts=True)
                often = n >= max(16, len(slots) // 500)
                yield pa.RecordBatch.from_arrays([pa.array(value[often]), pa.array(np.full(often.sum(), r, np.int64)), pa.array(n[often].astype(np.int64))], names=["slot", "root", "n"])

    if of_roots is not None and not len(of_roots):
        return {}
    rows = nodes.select("print", *(["root"] if of_roots is not None else [])).mapInArrow(run, "slot long, root long, n long")
    rows = rows.groupBy("slot", "root").agg(F.sum("n").alias("n")).groupBy("slot").agg(F.max(F.struct("n", "root")).alias("m")).where(F.col("m.n") > hot)
    return {r.slot: (-(-r.m.n // hot), r.m.root) for r in rows.collect()}


def _postings(nodes: DataFrame, combos: tuple, parts: int, hot: dict[int, tuple[int, int]], rooted: bool) -> DataFrame:
    """``part, blob``: postings by parts: list, key, two times 64 bits; if ``rooted`` two more, the root, and the number of shingles.

    Without roots the members of a hot list are dealt to its pieces; with them only those of its root, and the others go to each piece.
    """
    more = ["root", "size"] if rooted else []
    names = ["key", "print", "size", *more[:1]]
    slots_hot = np.array(sorted(hot), np.int64)
    pieces, roots = (np.array([hot[s][k] for s in slots_hot.tolist()], np.int64) for k in (0, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 8192):
                batch = whole.slice(at, 8192)
                prints, small = batch.column(1).to_pylist(), np.flatnonzero(batch.column(2).to_numpy() <= SMALL)
                slots, bits = _slots(prints, combos)
                extra = _slots([prints[i] for i in small], MORE[len(combos[0])], len(combos))[0]
                each = np.concatenate([np.repeat(np.arange(len(slots)), slots.shape[1]), np.repeat(small, extra.shape[1])])
                cols = [np.concatenate([slots.ravel(), extra.ravel()]), *(x[each] for x in (batch.column(0).to_numpy(), *bits[:, : 4 if rooted else 2].T, *(batch.column(names.index(c)).to_numpy() for c in more)))]
                piece = np.zeros(len(each), np.int64)
                if len(slots_hot):
                    place = np.minimum(np.searchsorted(slots_hot, cols[0]), len(slots_hot) - 1)
                    of_hot = np.flatnonzero(slots_hot[place] == cols[0])
                    piece[of_hot] = (cols[1][of_hot].view(np.uint64) % pieces[place[of_hot]].astype(np.uint64)).astype(np.int64)
                    if rooted:
                        others = of_hot[cols[6][of_hot] != roots[place[of_hot]]]
                        again = np.repeat(others, pieces[place[others]] - 1)
                        first = np.cumsum(pieces[place[others]] - 1) - (pieces[place[others]] - 1)
                        piece[others] = 0
                        piece = np.concatenate([piece, np.arange(len(again)) - np.repeat(first, pieces[place[others]] - 1) + 1])
                        cols = [np.concatenate([c, c[again]]) for c in cols]
                lists = cols[0] * (1 << 20) + piece  # pieces are lists of their own
                part = (_mixed(lists.view(np.uint64)) % np.uint64(parts)).astype(np.int64)
                cols[0] = lists
                order = np.argsort(part, kind="stable")
                own = np.split(order, np.flatnonzero(np.diff(part[order])) + 1)
                yield pa.RecordBatch.from_arrays([pa.array([int(part[o[0]]) for o in own], pa.int64()), pa.array([pack(*(c[o] for c in cols)) for o in own], pa.binary())], names=["part", "blob"])

    return nodes.select(*names).mapInArrow(run, "part long, blob binary")


def _lists(t: pa.Table) -> list[np.ndarray]:
    """The postings of a part, by list and then by their bits, with each one's list end: ``end, slot, key, bits[, root, size]``."""
    lists, *rest = (np.concatenate([np.frombuffer(b, np.int64) for b in col]) for col in zip(*(unpack(x.as_py()) for x in t.column("blob")), strict=True))
    order = np.lexsort((rest[1].view(np.uint64), lists))
    lists = lists[order]
    first, size = np.unique(lists, return_index=True, return_counts=True)[1:]
    words = 4 if len(rest) > 3 else 2
    return [np.repeat(first + size, size), lists >> 20, rest[0][order], [c[order] for c in rest[1 : 1 + words]], *(c[order] for c in rest[1 + words :])]


def _differ(bits: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    return sum(np.bitwise_count((x[i] ^ x[j]).view(np.uint64)).astype(np.int16) for x in bits)  # of signed numbers it counts the bits of the absolute value


def nearest_pairs(end: np.ndarray, slot: np.ndarray, key: np.ndarray, bits: list[np.ndarray], near_bits: int = FIRST_BITS, reach: int = REACH) -> tuple[np.ndarray, np.ndarray]:
    """Keys ``a <= b``: of each key and its nearest neighbour in any list, and of each with itself if it stands in a list longer than ``reach``."""
    n = len(key)
    best, who = np.full(n, near_bits + 1, np.int16), np.full(n, -1)
    at = np.arange(n)
    for k in range(1, reach + 1):
        at = at[at + k < end[at]]
        if not len(at):
            break
        d = _differ(bits, at, at + k)
        near = np.flatnonzero(d <= near_bits)
        i, d = at[near], d[near]
        for own, other in ((i, i + k), (i + k, i)):
            better = d < best[own]
            best[own[better]], who[own[better]] = d[better], other[better]
    told = np.flatnonzero(who >= 0)
    told = told[np.lexsort((key[who[told]], best[told], key[told]))]
    told = told[np.unique(key[told], return_index=True)[1]]
    a, b = key[told], key[who[told]]
    alone = key[np.isin(end, end[at])] if len(at) else key[:0]  # at: postings with more than ``reach`` others after them
    pairs = np.unique(np.concatenate([np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), np.stack([alone, alone], axis=1)]), axis=0)
    return pairs[:, 0], pairs[:, 1]


def _first_shared(bits: list[np.ndarray], i: np.ndarray, j: np.ndarray, combos: tuple) -> np.ndarray:
    """Of the lists (combination and position) that can be told from the given bits, the first that two fingerprints share; -1 if none."""
    same = (np.stack([x[i] ^ x[j] for x in bits], axis=1).view(np.uint8) == 0) if len(i) else np.zeros((0, 8 * len(bits)), bool)
    shared, number = [], []
    for d, positions in enumerate(combos):
        n = same.shape[1] - max(positions)
        if n > 0:
            shared.append(np.logical_and.reduce([same[:, p : p + n] for p in positions]))
            number.append(np.arange(d * BYTES, d * BYTES + n))
    shared, number = np.concatenate(shared, axis=1), np.concatenate(number)
    return np.where(shared.any(axis=1), number[shared.argmax(axis=1)], -1)


def apart_pairs(end: np.ndarray, slot: np.ndarray, key: np.ndarray, bits: list[np.ndarray], root: np.ndarray, size: np.ndarray, common: np.ndarray, least: float = 0.8, near_bits: int = NEAR_BITS, combos: tuple = TWO) -> tuple[np.ndarray, np.ndarray]:
    """All keys ``a < b`` in one list that are near, have different roots and can be similar to ``least``: ``size`` shingles, of which ``common`` may be common to both.

    A pair is left to the first list that both ends are known to stand in. This is the plain form of
    :func:`near_roots`, which tests hold that one against: it grows with the square of a list.
    """
    found, n, index = [], len(key), slot >> 8 * len(combos[0])

    def chosen(i: np.ndarray, j: np.ndarray) -> None:
        both = np.minimum(common[i], common[j])
        ok = (root[i] != root[j]) & (both >= least * (size[i] + size[j] - both) - 1e-9)
        i, j = i[ok], j[ok]
        ok = _differ(bits, i, j) <= near_bits + TINY_NEAR * (np.minimum(size[i], size[j]) < TINY)
        i, j = i[ok], j[ok]
        first = _first_shared(bits, i, j, combos)
        ok = (first < 0) | (first == index[i])
        found.append((key[i[ok]], key[j[ok]]))

    can = common >= least * size - 1e-9
    begin = np.concatenate([[0], np.flatnonzero(np.diff(end)) + 1]) if n else np.zeros(0, np.int64)
    long = np.zeros(n, bool)
    for s in begin[end[begin] - begin > 256].tolist() if n else ():  # by root, each with what comes after its root
        long[s : end[s]] = True
        own = s + np.flatnonzero(can[s : end[s]])
        own = own[np.argsort(root[own], kind="stable")]
        stop = np.searchsorted(root[own], root[own], "right")
        for k, low in enumerate(stop.tolist()):
            if low < len(own):
                chosen(np.full(len(own) - low, own[k]), own[low:])
    at = np.flatnonzero(~long & can)
    for k in range(1, 257):
        at = at[at + k < end[at]]
        if not len(at):
            break
        i = at[can[at + k]]
        chosen(i, i + k)
    a, b = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def near_roots(end: np.ndarray, slot: np.ndarray, key: np.ndarray, bits: list[np.ndarray], root: np.ndarray, size: np.ndarray, least: float = 0.8, near_bits: int = NEAR_BITS) -> tuple[np.ndarray, np.ndarray]:
    """A star of roots ``a, b`` for each class of roots that near members of one list connect; sizes must allow a similarity of ``least``.

    What is connected already isn't compared, so a list of near copies takes one row of comparisons and not all.
    """
    names, place = np.unique(root, return_inverse=True)
    label = np.arange(len(names))

    def compare(i: np.ndarray, j: np.ndarray) -> None:
        ok = label[place[i]] != label[place[j]]
        i, j = i[ok], j[ok]
        less, more = np.minimum(size[i], size[j]), np.maximum(size[i], size[j])
        ok = less >= least * more - 1e-9
        i, j, less = i[ok], j[ok], less[ok]
        ok = _differ(bits, i, j) <= near_bits + TINY_NEAR * (less < TINY)
        if ok.any():
            merge(label, place[i[ok]], place[j[ok]])

    begin = np.concatenate([[0], np.flatnonzero(np.diff(end)) + 1]) if len(end) else np.zeros(0, np.int64)
    length = end[begin] - begin
    at = np.flatnonzero(np.repeat(length <= LONG_LIST, length))
    for k in range(1, LONG_LIST):
        at = at[at + k < end[at]]
        if not len(at):
            break
        compare(at, at + k)
        if not k & k - 1:  # now and then lists of one class are left out
            own = label[place]
            at = at[np.repeat(np.minimum.reduceat(own, begin) != np.maximum.reduceat(own, begin), length)[at]]
    for s in begin[length > LONG_LIST].tolist():
        rest = np.arange(s, end[s])
        while len(rest):  # the largest class grows until nothing of the rest is near to any of it
            own, number, times = np.unique(label[place[rest]], return_inverse=True, return_counts=True)
            if len(own) == 1:
                break
            todo, rest = rest[number == times.argmax()], rest[number != times.argmax()]
            while len(todo) and len(rest):
                head, todo = np.split(todo, [max(1, (1 << 16) // len(rest))])
                compare(np.repeat(head, len(rest)), np.tile(rest, len(head)))
                joined = label[place[rest]] == label[place[head[0]]]
                todo, rest = np.concatenate([todo, rest[joined]]), rest[~joined]
    moved = np.flatnonzero(label != np.arange(len(label)))
    return names[moved], names[label[moved]]


def linked(root: np.ndarray, prints: np.ndarray, own: list[np.ndarray], of_a: np.ndarray, of_b: np.ndarray, least: float = 0.8) -> list[tuple[int, int]]:
    """Of nodes with their roots, fingerprints (n x 8) and shingles: pairs of a node in ``of_a`` and one in ``of_b`` that are similar to ``least``, enough to connect all roots that such pairs connect."""
    names, place = np.unique(root, return_inverse=True)
    label, size = np.arange(len(names)), np.array([len(x) for x in own])
    number = np.unique(np.concatenate(own), return_inverse=True)[1]
    sets = np.split(number, np.cumsum(size)[:-1])
    of_all, has = np.concatenate([sets[k] for k in of_b]), np.zeros(number.max() + 1, bool)
    first, size_b, prints_b = np.cumsum(size[of_b]) - size[of_b], size[of_b], prints[of_b]
    out = []
    for x in of_a.tolist():
        less, more = np.minimum(size[x], size_b), np.maximum(size[x], size_b)
        ok = np.flatnonzero((label[place[of_b]] != label[place[x]]) & (less >= least * more - 1e-9))
        if len(ok):
            bits = np.bitwise_count(prints_b[ok] ^ prints[x]).sum(axis=1, dtype=np.int64)
            ok = ok[bits <= ALL_BITS + TINY_ALL * (less[ok] < TINY)]
        if not len(ok):
            continue
        has[sets[x]] = True
        both = np.add.reduceat(has[of_all], first, dtype=np.int64)[ok]
        has[sets[x]] = False
        hits = of_b[ok[both / (size[x] + size_b[ok] - both) >= least]]
        hits = hits[np.unique(label[place[hits]], return_index=True)[1]]
        if len(hits):
            out += [(x, y) for y in hits.tolist()]
            merge(label, np.full(len(hits), place[x]), place[hits])
    return out


def _met(nodes: DataFrame, sets: DataFrame, near: DataFrame, least: float) -> DataFrame:
    """Edges ``a, b`` that connect all nodes (``key, print, root``) of a near class (``near``: the class of a root) that are near and similar to ``least``. Written.

    A class's nodes are dealt to pieces: those of its largest root, and the rest. Each piece of the rest
    meets itself and every other piece.
    """
    cores = nodes.sparkSession.sparkContext.defaultParallelism
    members = materialise(nodes.select("key", "print", "root").join(small(near), "root").join(sets, "key"), "members")
    of_root = members.groupBy("near", "root").agg(F.sum(F.octet_length("own")).alias("n"))
    plan = plan_table = materialise(of_root.groupBy("near").agg(F.max(F.struct("n", "root")).alias("m"), F.sum("n").alias("n")).select("near", F.col("m.root").alias("main"), F.col("m.n").alias("of_main"), (F.col("n") - F.col("m.n")).alias("of_rest")), "plan")
    total = plan.agg(F.sum(F.col("of_main") + F.col("of_rest"))).first()[0] or 0
    size = min(PIECE[1], max(PIECE[0], total // (64 * cores)))
    mains, rests = (F.ceil(F.col(c) / size).cast("long") for c in ("of_main", "of_rest"))
    sent = plan.agg(F.sum(F.col("of_main") * rests + F.col("of_rest") * (mains + rests))).first()[0] or 0
    parts = max(4 * cores, -(-sent // PART_BYTES))
    plan = plan.select("near", "main", mains.alias("of_main"), rests.alias("of_rest"))
    rows = members.join(small(plan), "near").withColumn("is_main", F.col("root") == F.col("main"))
    rows = rows.withColumn("piece", F.when(F.col("is_main"), F.col("of_rest") + F.pmod(F.xxhash64("key"), "of_main")).otherwise(F.pmod(F.xxhash64("key"), "of_rest")))
    others = F.sequence(F.lit(0).cast("long"), F.when(F.col("is_main"), F.col("of_rest") - 1).otherwise(F.col("of_rest") + F.col("of_main") - 1))
    rows = rows.withColumn("other", F.explode(others)).select("near", F.least("piece", "other").alias("i"), F.greatest("piece", "other").alias("j"), "piece", "key", "root", "print", "own")

    @released
    def meet(t: pa.Table) -> pa.Table:
        near, i, j, of, key, root = (t.column(c).to_numpy() for c in ("near", "i", "j", "piece", "key", "root"))
        prints = np.frombuffer(b"".join(t.column("print").to_pylist()), np.uint64).reshape(-1, BYTES // 8)
        own = [np.frombuffer(x, np.uint64) for x in t.column("own").to_pylist()]
        order = np.lexsort((key, j, i, near))
        cuts = np.flatnonzero((np.diff(near[order]) != 0) | (np.diff(i[order]) != 0) | (np.diff(j[order]) != 0)) + 1
        a, b = [], []
        for at in np.split(order, cuts):
            of_a, of_b = np.flatnonzero(of[at] == i[at]), np.flatnonzero(of[at] == j[at])
            for x, y in linked(root[at], prints[at], [own[k] for k in at], of_a, of_b, least) if len(of_a) and len(of_b) else ():
                a.append(key[at[x]])
                b.append(key[at[y]])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    out = materialise(rows.withColumn("part", F.pmod(F.xxhash64("near", "i", "j"), F.lit(parts))).groupBy("part").applyInArrow(meet, "a long, b long"), "met")
    for x in (members, plan_table):
        drop_table(x)
    return out


def _told(nodes: DataFrame, count: int, combos: tuple, find, hot: dict, rooted: bool) -> DataFrame:
    """Distinct pairs ``a, b`` that ``find`` tells of the lists of each part."""
    parts = max(4 * nodes.sparkSession.sparkContext.defaultParallelism, -(-count * BYTES * len(combos) // PART_ROWS))

    @released
    def meet(t: pa.Table) -> pa.Table:
        a, b = find(*_lists(t))
        return pa.table({"a": pa.array(a), "b": pa.array(b)})

    return _postings(nodes, combos, parts, hot, rooted).groupBy("part").applyInArrow(meet, "a long, b long").distinct()


def _measured(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``a, b, bits`` of the pairs whose whole fingerprints differ in few bits."""
    rows = pairs.join(nodes.select(F.col("key").alias("a"), F.col("print").alias("pa"), F.col("size").alias("na")), "a").join(nodes.select(F.col("key").alias("b"), F.col("print").alias("pb"), F.col("size").alias("nb")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                p, q = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint64).reshape(-1, BYTES // 8) for k in (2, 3))
                bits = np.bitwise_count(p ^ q).sum(axis=1, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bits)], names=["a", "b", "bits"]).filter(pa.array(bits <= ALL_BITS + TINY_ALL * (batch.column(4).to_numpy() < TINY)))

    return rows.select("a", "b", "pa", "pb", F.least("na", "nb")).mapInArrow(run, "a long, b long, bits long")


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """``a, b, same``: whether the Jaccard similarity of the pair's shingles reaches ``least``. Written."""
    rows = pairs.select("a", "b").join(sets.select(F.col("key").alias("a"), F.col("own").alias("p")), "a").join(sets.select(F.col("key").alias("b"), F.col("own").alias("q")), "b")
    as_set = lambda x: np.frombuffer(x, np.uint64)
    judge = lambda a, b, p, q: (a, b, [jaccard(as_set(s), as_set(t)) >= least for s, t in zip(p, q, strict=True)])
    return materialise(map_rows(rows, ["a", "b", "p", "q"], lambda: judge, "a long, b long, same boolean"), "verified")


def links(docs: DataFrame, nodes: DataFrame, least: float = 0.8, size: int = 5, wide: int = WIDE, hot: int = HOT_LIST) -> DataFrame:
    """Edges ``a, b`` between nodes (``key, print, text_hash, size``) that connect all near pairs whose shingles are similar to ``least``."""
    count = nodes.count()
    combos = TWO if count <= wide else THREE
    told = materialise(_told(nodes, count, combos, nearest_pairs, _hot_lists(nodes, combos, hot), False), "told")
    marked = materialise(nodes.join(told.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "key", "left_semi").select("key", "print", "text_hash", "size"), "marked")
    texts = docs.select(F.xxhash64("text").alias("text_hash"), "text").join(small(marked.select("text_hash", "key")), "text_hash").groupBy("key").agg(F.min("text").alias("text"))
    sets = materialise(map_rows(texts, ["key", "text"], lambda: lambda keys, own: (keys, [shingles(t, size).tobytes() for t in own]), "key long, own binary"), "sets")

    first = materialise(_measured(told.where("a <> b"), marked), "near")
    ends = first.select("a", "b", "bits", F.explode(F.array("a", "b")).alias("key"))
    picked = ends.groupBy("key").agg(F.min(F.struct("bits", "a", "b")).alias("m")).select("m.a", "m.b")
    checked = _verified(picked.unionByName(first.where(F.col("bits") <= LIKELY_BITS).select("a", "b")).distinct(), sets, least).where("same").select("a", "b")

    roots = materialise(components(checked), "roots")
    of_root = marked.join(roots.withColumnRenamed("node", "key"), "key", "left").select("key", "print", F.coalesce("root", "key").alias("root"), "size")
    of_root = materialise(of_root, "rooted")
    n_marked = of_root.count()
    big = of_root.groupBy("root").count().where(F.col("count") > max(hot, n_marked // 1000)).select("root").collect()  # 1000 at most
    again = _hot_lists(of_root, combos, hot, np.array(sorted(r.root for r in big), np.int64))
    apart = materialise(_told(of_root, n_marked, combos, lambda *cols: near_roots(*cols, least), again, True), "apart")
    met = _met(of_root, sets, components(apart).select(F.col("node").alias("root"), F.col("root").alias("near")), least)
    for x in (told, first, sets, marked, of_root, apart, roots):
        drop_table(x)
    return checked.unionByName(met)


def classified(docs: DataFrame, least: float = 0.8, size: int = 5, wide: int = WIDE, hot: int = HOT_LIST) -> DataFrame:
    """Per row ``doc_id, text_hash, component_id``: the least doc_id reachable over pairs of texts that are similar to ``least``.

    Texts without words (null, empty) are one group. Null doc_ids get the least
    other id of their group, or null; repeated rows come back each; an empty
    table gives none. Columns other than ``doc_id, text`` aren't read.
    """
    small_batches(docs.sparkSession)
    prints = materialise(_prints(docs, size), "prints")
    first = materialise(prints.groupBy("key").agg(F.min("doc_id").alias("first_id"), F.min("text_hash").alias("text_hash"), F.first("print").alias("print"), F.first("size").alias("size")), "nodes")
    edges = links(docs, first.where("print is not null"), least, size, wide, hot)
    roots = components(edges).withColumnsRenamed({"node": "key"})
    classes = first.join(roots, "key", "left").select("key", "first_id", F.coalesce("root", "key").alias("root"))
    of_root = classes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_key = materialise(classes.join(of_root, "root").select("key", "component_id"), "classes")
    return prints.join(of_key, "key").select("doc_id", "text_hash", "component_id")


def one_of_each(docs: DataFrame, least: float = 0.8, size: int = 5) -> DataFrame:
    """``docs`` without all but the least doc_id of each group of near copies, columns unchanged; null and repeated ids as in simhash."""
    return keep_least(docs, classified(docs, least, size))
