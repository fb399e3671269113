"""A hashed maximum-entropy language model: class-factored softmax over n-gram and skip features.

A word is reached by choices among 16 branches, one after another: the most
frequent words stand at the leaves of a Huffman tree, of which one more leaf is
for all other words. Below that leaf come three choices that lead to one of
4096 classes, by the word's ending and its hash. Each choice is a softmax over
the sum of weight rows that features of the history hash to together with the
place in the tree: the last word, the last two together, and the second last
alone. So P(word | history) is the product of the choices, and for a word that
isn't among the most frequent times its share of its class, smoothed by one,
with a place for words that training didn't have.
"""

from __future__ import annotations

import heapq
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import BATCH_BYTES, PART_BYTES, as_table, pack, parts_for, released, total_bytes, unpack
from .common import crc_mod_py, materialise, small_batches

#: Frequent words that have a leaf of their own; choices below the leaf of the others.
TOP, DEEP = 4096, 3
WAYS = 16
#: Weight rows: one for so many bytes of text, in powers of two between these.
ROW_BYTES, LEAST_ROWS, MOST_ROWS = 1024, 1 << 14, 1 << 18
#: Lots of batches that are learnt one after another, each from the mean of what the lot before learnt.
ROUNDS = 3
#: Tokens of a gradient step, and of a lot that is scored together.
STEP = 2048
RATE = 0.2
#: Weight rows that move together, few enough to stay in a core's cache.
_NEAR = 2048
SLICES = 16
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_PAIR = np.uint64(0x27D4EB2F165667C5)


class Params(NamedTuple):
    parts: int
    mod: int
    rest: int
    top: int
    rows: int


def rows_for(total: int) -> int:
    """Weight rows for so many bytes of text."""
    return max(LEAST_ROWS, min(MOST_ROWS, 1 << (total // ROW_BYTES).bit_length()))


def tokens(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased, then the end token, which is the empty string."""
    out = text.encode().lower().split() if text else []
    out.append(b"")
    return out


def rare_class(word: bytes) -> int:
    """The class of a word without a leaf: by its last two bytes, then by all of them."""
    return zlib.crc32(word[-2:]) % WAYS << 4 * (DEEP - 1) | zlib.crc32(word) >> 7 & (1 << 4 * (DEEP - 1)) - 1


def rare_classes(words: list[bytes]) -> np.ndarray:
    """:func:`rare_class` of each word."""
    ends = np.fromiter(map(zlib.crc32, [w[-2:] for w in words]), np.int64, len(words))
    whole = np.fromiter(map(zlib.crc32, words), np.int64, len(words))
    return ends % WAYS << 4 * (DEEP - 1) | whole >> 7 & (1 << 4 * (DEEP - 1)) - 1


class Batch:
    """Tokens of a batch's documents as numbers of its distinct words.

    It is made from texts once and kept as bytes, so that training and scoring
    don't cut the texts again.
    """

    def __init__(self, p: Params, ids: np.ndarray, null: np.ndarray, size: np.ndarray, tokens: np.ndarray, words: list[bytes]):
        self.p, self.ids, self.null, self.size, self.tokens, self.words = p, ids, null, size, tokens, words
        self.held_out = np.array([crc_mod_py(None if n else i, p.mod) == p.rest for i, n in zip(ids.tolist(), null.tolist(), strict=True)], bool)
        self.hash = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
        part = (self.hash % np.uint64(p.parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        lots = np.split(order, np.flatnonzero(np.diff(part[order])) + 1)
        self.by_part = {int(part[x[0]]): x for x in lots if len(x)}

    @classmethod
    def of_texts(cls, ids: list[int | None], texts: list[str | None], p: Params) -> Batch:
        """Gives each text the words of :func:`tokens`; Arrow cuts and numbers them without an object for each."""
        lower = pa.compute.ascii_lower(pa.array([t or "" for t in texts], pa.large_string()))
        cut = pa.compute.ascii_split_whitespace(lower)
        flat, bounds = cut.flatten(), cut.offsets.to_numpy()
        full = pa.compute.binary_length(flat).to_numpy(zero_copy_only=False) > 0  # spaces at an end of a text leave an empty piece there
        coded = flat.filter(pa.array(full)).dictionary_encode()
        words = [*coded.dictionary.cast(pa.large_binary()).to_pylist(), b""]
        size = np.diff(np.concatenate([[0], np.cumsum(full)])[bounds - bounds[0]]) + 1
        numbers = np.full(int(size.sum()), len(words) - 1, np.int32)
        inside = np.ones(len(numbers), bool)
        inside[np.cumsum(size) - 1] = False
        numbers[inside] = coded.indices.to_numpy()
        return cls(p, np.array([i or 0 for i in ids], np.int64), np.array([i is None for i in ids], bool), size, numbers, words)

    def dump(self) -> bytes:
        return pack(self.ids, self.null, self.size, self.tokens, b" ".join(self.words))

    @classmethod
    def load(cls, blob: bytes, p: Params) -> Batch:
        *numbers, words = unpack(blob)
        return cls(p, *(np.frombuffer(x, t) for x, t in zip(numbers, (np.int64, bool, np.int64, np.int32), strict=True)), words.split(b" "))

    def told(self):
        """For each part: its words, and how often the training documents of the batch have them."""
        count = np.bincount(self.tokens[np.repeat(~self.held_out, self.size)], minlength=len(self.words))
        for part, own in self.by_part.items():
            yield part, pack(b" ".join(map(self.words.__getitem__, own.tolist())), count[own].astype(np.uint32))

    def counts(self, replies: list[tuple[int, bytes]]) -> np.ndarray:
        out = np.zeros(len(self.words), np.int64)
        for part, blob in replies:
            out[self.by_part[part]] = np.frombuffer(unpack(blob)[0], np.int64)
        return out


class Tree(NamedTuple):
    """Leaves are numbered: frequent words by rank, then the classes of the others. The path of leaf i is the places
    ``first[i]`` to ``first[i + 1]`` of ``node`` and ``branch``; ``bias`` has the logits of a node's branches that counts give."""

    top: dict[bytes, int]
    first: np.ndarray
    node: np.ndarray
    branch: np.ndarray
    bias: np.ndarray
    tokens: np.ndarray
    words: np.ndarray
    n: int
    v: int

    @classmethod
    def of_counts(cls, best: list[tuple[bytes, int]], tokens: np.ndarray, words: np.ndarray, n: int, v: int) -> Tree:
        """``best``: frequent words with their counts; ``tokens, words`` of each class without these; ``n, v`` with them."""
        rest = len(best)
        heap = [(c, k) for k, (_, c) in enumerate(best)] + [(int(tokens.sum()) + 1, rest)]
        heap += [(0, -1)] * (-(len(heap) - 1) % (WAYS - 1))  # branches that lead nowhere
        heapq.heapify(heap)
        weight, kids, name = {}, {}, rest + 1
        while len(heap) > 1:
            own = [heapq.heappop(heap) for _ in range(WAYS)]
            weight[name], kids[name] = [c for c, _ in own], [k for _, k in own]
            heapq.heappush(heap, (sum(weight[name]), name))
            name += 1
        paths, logits, open_nodes = {}, [], [(heap[0][1], ())]
        while open_nodes:
            at, path = open_nodes.pop()
            if at in kids:
                logits.append([np.log(c + 1.0) if k >= 0 else -1e4 for c, k in zip(weight[at], kids[at], strict=True)])
                open_nodes += [(k, (*path, (len(logits) - 1, b))) for b, k in enumerate(kids[at]) if k >= 0]
            elif at <= rest:
                paths[at] = path
        below, start = [[]], len(logits)
        for deep in range(DEEP):
            size = WAYS**deep
            mass = tokens.reshape(size, WAYS, -1).sum(axis=2)
            logits += np.log(mass + 1.0).tolist()
            below = [[*p, (start + k, b)] for k, p in enumerate(below) for b in range(WAYS)]
            start += size
        all_paths = [paths[k] for k in range(rest)] + [(*paths[rest], *p) for p in below]
        bias = np.array(logits, np.float32)
        bias -= np.log(np.exp(bias).sum(axis=1, keepdims=True))
        flat = np.array([x for p in all_paths for x in p], np.int64).reshape(-1, 2)
        first = np.concatenate([[0], np.cumsum([len(p) for p in all_paths])])
        return cls({w: k for k, (w, _) in enumerate(best)}, first, flat[:, 0], flat[:, 1], bias, tokens, words, n, v)

    def of(self, words: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaf of each word, and log10 of its share of it."""
        e = rare_classes(words)
        leaf, share = e + len(self.top), np.log10((counts + 1) / (self.tokens[e] + self.words[e] + 1))
        get = self.top.get
        for k, rank in enumerate(map(get, words)):
            if rank is not None:
                leaf[k], share[k] = rank, 0.0
        return leaf, share

    def choices(self, leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each choice on the way to each of these leaves: which of them it is for, the node and the branch."""
        first = self.first.take(leaf)
        n = self.first.take(leaf + 1) - first
        which = np.repeat(np.arange(len(leaf)), n)
        first -= np.cumsum(n) - n
        place = first.take(which)
        place += np.arange(len(which))
        return which, self.node.take(place), self.branch.take(place)

    def room(self, leaves: int) -> np.ndarray:
        """Two rows of branches for each choice on the way to so many leaves; used again, since new memory costs a page fault each 4 KB."""
        return np.empty((2, leaves * int(np.diff(self.first).max()), WAYS), np.float32)


def features(batch: Batch) -> np.ndarray:
    """Hashes of each token's history (tokens x 3). Before the first word the history is a mark of its own."""
    n = len(batch.tokens)
    h = (batch.hash + np.uint64(1))[batch.tokens]
    first = np.cumsum(batch.size) - batch.size
    out = np.zeros((n, 3), np.uint64)
    out[1:, 0], out[2:, 2] = h[:-1], h[:-2]
    out[first, 0] = out[first, 2] = 0
    out[first[first < n - 1] + 1, 2] = 0  # the end token is there, or the next document
    out[:, 1] = out[:, 0] * _PAIR + out[:, 2]
    out += np.arange(3, dtype=np.uint64)
    out *= _MIX
    out ^= out >> np.uint64(31)
    return out


def weight_rows(f: np.ndarray, node: np.ndarray, rows: int) -> np.ndarray:
    """Weight rows of choices (choices x 3), from the hashes of their histories and their nodes."""
    x = (f + (node.astype(np.uint64) * _PAIR)[:, None]) * _MIX[1]
    x ^= x >> np.uint64(32)
    x *= _MIX[0]
    x >>= np.uint64(64 - rows.bit_length() + 1)
    return x.view(np.int64)


def softmaxes(rows: np.ndarray, start: np.ndarray, weights: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logits and exponentials of each choice's branches, both in ``room``, and the sums of these as a column."""
    z, e = room[0, : len(rows)], room[1, : len(rows)]
    weights.take(rows[:, 0], 0, out=z, mode="clip")  # other modes copy what they are given
    for k in range(1, rows.shape[1]):
        z += weights.take(rows[:, k], 0, out=e, mode="clip")
    z += start
    np.clip(z, -30, 30, out=z)
    np.exp(z, out=e)
    return z, e, e @ np.ones((e.shape[1], 1), e.dtype)


def log_leaf(f: np.ndarray, leaf: np.ndarray, tree: Tree, weights: np.ndarray, step: int = STEP) -> np.ndarray:
    """Natural log of the probability of each token's leaf."""
    out, room = np.zeros(len(leaf)), tree.room(min(step, len(leaf)))
    for at in range(0, len(leaf), step):
        which, node, branch = tree.choices(leaf[at : at + step])
        z, _, total = softmaxes(weight_rows(f[at : at + step].take(which, 0), node, len(weights)), tree.bias.take(node, 0), weights, room)
        chosen = z.ravel().take(np.arange(0, z.size, WAYS) + branch).astype(float) - np.log(total[:, 0])
        out[at : at + step] = np.add.reduceat(chosen, np.flatnonzero(np.concatenate([[True], which[1:] != which[:-1]])))
    return out


def gradient_pass(f: np.ndarray, leaf: np.ndarray, tree: Tree, weights: np.ndarray, rate: float = RATE, step: int = STEP) -> np.ndarray:
    """One pass of scaled gradient steps (the scale of a row falls with what it has moved), in place. Returns which rows moved."""
    moved = np.full(len(weights), 1e-3, np.float32)
    mean = np.full(WAYS, 1 / WAYS, np.float32)
    rate = np.float32(rate / np.sqrt(f.shape[1]))
    room, near = tree.room(min(step, len(f))), np.empty((2, _NEAR, WAYS), np.float32)
    for at in range(0, len(f), step):
        which, node, branch = tree.choices(leaf[at : at + step])
        rows = weight_rows(f[at : at + step].take(which, 0), node, len(weights))
        _, g, total = softmaxes(rows, tree.bias.take(node, 0), weights, room)
        g /= total
        g.ravel()[np.arange(0, g.size, WAYS) + branch] -= 1
        bits = len(g).bit_length()
        key = np.sort(((rows << bits) | np.arange(len(g))[:, None]).ravel())  # weight row, then choice
        choice = key & ((1 << bits) - 1)
        key >>= bits
        head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        times = np.diff(np.append(head, len(key)))
        own, lone = key.take(head), choice.take(head)
        again = np.flatnonzero(times > 1)  # most rows come once in a step
        n, start = times.take(again), head.take(again)
        more = g.take(lone.take(again), 0)
        more += g.take(choice.take(start + 1), 0)
        if len(many := np.flatnonzero(n > 2)):
            n, start = n.take(many), start.take(many)
            first = np.cumsum(n) - n
            place = np.repeat(start - first, n) + np.arange(n.sum())
            more[many] = np.add.reduceat(g.take(choice.take(place), 0), first, axis=0)
        for low in range(0, len(own), _NEAR):
            to = own[low : low + _NEAR]
            slope, other = near[0, : len(to)], near[1, : len(to)]
            g.take(lone[low : low + _NEAR], 0, out=slope, mode="clip")
            a, b = np.searchsorted(again, (low, low + _NEAR))
            slope[again[a:b] - low] = more[a:b]
            scale = moved.take(to) + np.multiply(slope, slope, out=other) @ mean
            moved[to] = scale
            np.sqrt(scale, out=scale)
            slope *= (-rate / scale)[:, None]
            slope += weights.take(to, 0, out=other, mode="clip")
            weights[to] = slope
    return moved > 1e-3


_MESSAGE = {"part": pa.int64(), "_batch": pa.int64(), "blob": pa.binary()}
_ANSWER = _MESSAGE | {"word": pa.binary(), "cls": pa.int64(), "n": pa.int64(), "v": pa.int64()}


def _meet(t: pa.Table, p: Params) -> pa.Table:
    """Sums a part's counts over batches; answers each; tells the part's most frequent words and the sums of its endings."""
    part = t.column("part")[0].as_py()
    number: dict[bytes, int] = {}
    own, total = [], np.zeros(0, np.int64)
    for blob in t.column("blob").to_pylist():
        words, counts = unpack(blob)
        own_words = words.split(b" ")
        for w in own_words:
            if w not in number:
                number[w] = len(number)
        at = np.fromiter(map(number.__getitem__, own_words), np.int64, len(own_words))
        if len(number) > len(total):
            total = np.concatenate([total, np.zeros(len(number), np.int64)])
        total[at] += np.frombuffer(counts, np.uint32)  # a batch names a word once
        own.append(at)
    total = total[: len(number)]
    rows = [(part, b, pack(total[at]), None, None, None, None) for b, at in zip(t.column("_batch").to_pylist(), own, strict=True)]
    words = list(number)
    known = np.flatnonzero(total)
    least = np.sort(total)[-min(p.top, len(total))]
    best = sorted((k for k in known.tolist() if total[k] >= least), key=lambda k: (-total[k], words[k]))[: p.top]
    rows += [(part, None, None, words[k], None, int(total[k]), 1) for k in best]
    if len(known):
        e = rare_classes([words[k] for k in known.tolist()])
        n, v = np.bincount(e, total[known]), np.bincount(e)
        rows += [(part, None, None, None, k, int(n[k]), int(v[k])) for k in np.flatnonzero(v).tolist()]
    return as_table(rows, _ANSWER)


class Trained(NamedTuple):
    """A trained model with the written batches and answers that score the documents it was given."""

    batches: DataFrame
    answers: DataFrame
    tree: Tree
    weights: np.ndarray
    params: Params


def train(docs: DataFrame, held_out: tuple[int, int] = (7, 2), top: int = TOP, rows: int | None = None, rounds: int = ROUNDS, batch_bytes: int = BATCH_BYTES, part_bytes: int = PART_BYTES) -> Trained:
    """Counts words and trains weights on all documents that aren't held out; ``rows`` grows with the text unless given.

    Batches are dealt to ``rounds`` lots. In each round every batch of a lot
    takes gradient steps over all its training tokens from the same weights. A
    weight row then moves by the mean over the batches that moved it: within a
    task first, then in two levels of groups, so that neither a task nor the
    driver gathers more than the model's size times a bounded number. Null and
    empty texts are one end token; repeated rows count each; without any
    document nothing is learnt. Columns other than ``doc_id, text`` aren't read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    total = total_bytes(docs)
    p = Params(parts_for(total, part_bytes), *held_out, top, rows or rows_for(total))
    message = "part long, _batch long, blob binary"

    def tell(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Batches by size as rows come; a batch's own bytes have no part."""
        number, ids, texts, size = TaskContext.get().partitionId() << 24, [], [], 0
        for r in chain(rows, [None]):
            for doc_id, text in zip(*(c.to_pylist() for c in r.columns), strict=True) if r is not None else ():
                ids.append(doc_id)
                texts.append(text)
                size += 4 * len(text or "") // 3
                if size >= batch_bytes:
                    yield told_of(number, ids, texts)
                    number, ids, texts, size = number + 1, [], [], 0
        if ids:
            yield told_of(number, ids, texts)

    def told_of(number: int, ids: list, texts: list) -> pa.RecordBatch:
        batch = Batch.of_texts(ids, texts, p)
        out = as_table([(None, number, batch.dump()), *((part, number, blob) for part, blob in batch.told())], _MESSAGE)
        return out.combine_chunks().to_batches()[0]

    name = f"quillmark_told_{uuid.uuid4().hex}"
    told = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(tell, message)
    told.write.option("compression", "uncompressed").bucketBy(max(1, min(50_000, -(-total // (2 * batch_bytes)))), "_batch").saveAsTable(name, format="parquet")
    told = spark.table(name)  # bucketed by batch: what reads it by batch needs no shuffle
    batches = told.where("part is null").select("_batch", "blob")
    met = told.where("part is not null").groupBy("part").applyInArrow(released(lambda t: _meet(t, p)), message + ", word binary, cls long, n long, v long")
    met = materialise(met, "counts")
    answers = met.where("blob is not null").select("part", "_batch", "blob")
    best = met.where("word is not null").orderBy(F.desc("n"), "word").limit(top).collect()
    n, v = np.zeros(WAYS**DEEP, np.int64), np.zeros(WAYS**DEEP, np.int64)
    for r in met.where("cls is not null").groupBy("cls").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():  # 4096 at most
        n[r.cls], v[r.cls] = r.n, r.v
    all_n, all_v = int(n.sum()), int(v.sum())
    for r in best:
        e = rare_class(bytes(r.word))
        n[e] -= r.n
        v[e] -= 1
    tree = Tree.of_counts([(bytes(r.word), r.n) for r in best], n, v, all_n, all_v)
    weights = np.zeros((p.rows, WAYS), np.float32)
    for k in range(rounds):
        lot = F.pmod(F.xxhash64("_batch"), F.lit(rounds)) == k
        weights = _round(batches.where(lot), answers.where(lot), tree, weights, p)
    return Trained(batches, answers, tree, weights, p)


def _round(batches: DataFrame, answers: DataFrame, tree: Tree, weights: np.ndarray, p: Params) -> np.ndarray:
    sent = batches.sparkSession.sparkContext.broadcast((tree, weights))

    @released
    def learn(t: pa.Table, replies: pa.Table) -> pa.Table:
        tree, weights = sent.value
        if not t.num_rows:
            return as_table([], {"n": pa.binary(), "blob": pa.binary()})
        batch = Batch.load(t.column("blob")[0].as_py(), p)
        leaf, _ = tree.of(batch.words, batch.counts(list(zip(replies.column("part").to_pylist(), replies.column("blob").to_pylist(), strict=True))))
        use = np.flatnonzero(np.repeat(~batch.held_out, batch.size))
        own = weights.copy()
        moved = gradient_pass(features(batch).take(use, 0), leaf[batch.tokens.take(use)], tree, own)
        return as_table([(moved.astype(np.float32).tobytes(), (own - weights).astype(np.float16).tobytes())], {"n": pa.binary(), "blob": pa.binary()})

    height = p.rows // SLICES
    kinds = {"slice": pa.int64(), "n": pa.binary(), "blob": pa.binary()}

    def summed(messages) -> tuple[np.ndarray, np.ndarray] | None:
        """Sums of how many batches moved each row, and of their moves."""
        total, count = None, None
        for n, blob in messages:
            n = np.frombuffer(n, np.float32)
            x = np.frombuffer(blob, np.float16).astype(np.float32).reshape(-1, WAYS) * n[:, None]
            total, count = (x, n.copy()) if total is None else (total + x, count + n)
        return None if total is None else (count, total / np.maximum(count, 1)[:, None])

    def within_task(rows):
        found = summed((n, blob) for b in rows for n, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        if found:
            n, x = (c.reshape(SLICES, height, -1) for c in found)
            yield from as_table([(k, n[k].tobytes(), x[k].astype(np.float16).tobytes()) for k in range(SLICES)], kinds).to_batches()

    def mean(t: pa.Table) -> pa.Table:
        n, x = summed((a.as_py(), b.as_py()) for a, b in zip(t.column("n"), t.column("blob"), strict=True))
        return as_table([(t.column("slice")[0].as_py(), n.tobytes(), x.astype(np.float16).tobytes())], kinds)

    kind = "slice long, n binary, blob binary"
    moves = batches.groupBy("_batch").cogroup(answers.groupBy("_batch")).applyInArrow(learn, "n binary, blob binary").mapInArrow(within_task, kind)
    moves = moves.withColumn("lot", F.spark_partition_id() % 64).groupBy("slice", "lot").applyInArrow(mean, kind).groupBy("slice").applyInArrow(mean, kind)
    out = np.zeros((SLICES, height, WAYS), np.float32)
    for r in moves.select("slice", "blob").collect():
        out[r.slice] = np.frombuffer(r.blob, np.float16).reshape(height, WAYS)
    return weights + out.reshape(weights.shape)


_SCORED = {"doc_id": pa.int64(), "held_out": pa.bool_(), "n_tokens": pa.int64(), "n_known": pa.int64(), "train_tokens": pa.int64(), "base_score": pa.float64(), "score": pa.float64()}


def score(trained: Trained, step: int = STEP) -> DataFrame:
    """Per document given to :func:`train`: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    ``base_score``: log10 probability by counts smoothed by one; ``score``: by
    the model. Null and empty texts are one end token. Repeated rows are scored
    (and, if not held out, learnt) each; null doc_ids count as the empty id.
    """
    p = trained.params
    sent = trained.batches.sparkSession.sparkContext.broadcast((trained.tree, trained.weights))

    @released
    def judge(t: pa.Table, replies: pa.Table) -> pa.Table:
        if not t.num_rows:
            return as_table([], _SCORED)
        tree, weights = sent.value
        batch = Batch.load(t.column("blob")[0].as_py(), p)
        counts = batch.counts(list(zip(replies.column("part").to_pylist(), replies.column("blob").to_pylist(), strict=True)))
        leaf, share = tree.of(batch.words, counts)
        base = np.log10((counts + 1) / (tree.n + tree.v + 1))
        model = share[batch.tokens] + log_leaf(features(batch), leaf[batch.tokens], tree, weights, step) / np.log(10)
        first = np.cumsum(batch.size) - batch.size
        sums = [np.add.reduceat(x, first) for x in ((counts > 0)[batch.tokens].astype(np.int64), base[batch.tokens], model)]
        cols = [batch.ids, batch.held_out, batch.size, sums[0], np.full(len(first), tree.n), sums[1], sums[2]]
        out = {n: pa.array(c, k) for (n, k), c in zip(_SCORED.items(), cols, strict=True)}
        return pa.table(out | {"doc_id": pa.array(batch.ids, pa.int64(), mask=batch.null)})

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return trained.batches.groupBy("_batch").cogroup(trained.answers.groupBy("_batch")).applyInArrow(judge, schema)


def train_and_score(docs: DataFrame, **parameters) -> DataFrame:
    return score(train(docs, **parameters))
