"""Document quality from a linear-chain conditional random field that labels every line good or bad."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, crc_mod_py, map_rows, small_batches

#: Labelled documents and characters of them that a fit collects at most (the documents with the least id hashes).
TRAIN_DOCS, TRAIN_CHARS = 4000, 24_000_000
#: A document is taken into the sample only if it isn't longer; scoring has no such bound.
TRAIN_DOC_CHARS = 200_000
THRESHOLD = 0.7

_SYMBOLS, _DIGITS, _STOPS = b"#*$%&|<>~^=_{}[]\\@+", b"0123456789", b".,;:?!"
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
OWN = 14  # features of a line itself, without those of its neighbours


def _count(raw: bytes, chars: bytes) -> int:
    return len(raw) - len(raw.translate(None, chars))


def lines_of(text: str | None) -> list[bytes]:
    """Lines with a word; the others have no part in the chain."""
    return [x for x in (text or "").encode().split(b"\n") if x.strip()]


def line_features(lines: list[bytes]) -> np.ndarray:
    """Own features of each line, most of them shares between 0 and 1."""
    out = np.zeros((len(lines), OWN))
    seen: set[bytes] = set()
    for k, raw in enumerate(lines):
        parts = raw.split()
        n, w = len(raw), len(parts)
        different = len(set(parts))
        upper, lower = _count(raw, _UPPER), _count(raw, _LOWER)
        symbols, stops = _count(raw, _SYMBOLS), _count(raw, _STOPS)
        bangs = raw.count(b"!!")
        out[k] = (
            min(math.log1p(n) / 8, 2),
            min((n - w + 1) / w / 12, 2),
            min(4 * symbols / n, 1),
            upper / (upper + lower + 1),
            4 * min(_count(raw, _DIGITS) / n, 0.25),
            min(6 * stops / n, 1),
            min(bangs / w, 1),
            raw.rstrip()[-1:] in (b".", b"?", b"!", b":", b'"'),
            1 - different / w,
            min((w - different) / 20, 1) * (1 - different / w),
            raw in seen,
            min(2 * raw.count(b" | ") / w, 1),
            w < 4,
            max(0.0, 1 - w / 20),
        )
        seen.add(raw)
    return out


def chain_features(own: np.ndarray) -> np.ndarray:
    """A line's own features, those of the lines before and after, and where the document begins and ends."""
    n = len(own)
    zero = np.zeros((1, own.shape[1]))
    edges = np.zeros((n, 3))
    edges[:, 0], edges[0, 1], edges[-1, 2] = 1, 1, 1
    return np.hstack([own, np.vstack([zero, own[:-1]]), np.vstack([own[1:], zero]), edges])


def forward_backward(unary: list[np.ndarray], between: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Marginals of the lines (n x 2) and of neighbouring pairs (2 x 2, summed) of each chain, and its log partition.

    Chains are stepped through together, longest first, so that each step works
    on those that reach it.
    """
    sizes = np.array([len(u) for u in unary])
    order = np.argsort(-sizes, kind="stable")
    longest = int(sizes.max(initial=0))
    reach = np.array([np.count_nonzero(sizes > t) for t in range(longest)])
    offset = np.concatenate([[0], np.cumsum(reach)])
    flat = np.empty((offset[-1], 2))  # by step, then by chain
    for rank, k in enumerate(order):
        flat[offset[: sizes[k]] + rank] = unary[k]
    alpha, beta = np.empty_like(flat), np.zeros_like(flat)
    for t in range(longest):
        a, b = offset[t], offset[t + 1]
        alpha[a:b] = flat[a:b]
        if t:
            before = alpha[offset[t - 1] : offset[t - 1] + b - a]
            alpha[a:b] += np.logaddexp(before[:, :1] + between[0], before[:, 1:] + between[1])
    for t in range(longest - 2, -1, -1):
        a, c, d = offset[t], offset[t + 1], offset[t + 2]
        after = flat[c:d] + beta[c:d]
        beta[a : a + d - c] = np.logaddexp(between[:, 0] + after[:, :1], between[:, 1] + after[:, 1:])
    z = np.logaddexp(alpha[: len(order), 0] + beta[: len(order), 0], alpha[: len(order), 1] + beta[: len(order), 1]) if longest else np.zeros(0)
    pairs = np.zeros((len(unary), 2, 2))
    for t in range(1, longest):
        a, b, p = offset[t], offset[t + 1], offset[t - 1]
        joint = alpha[p : p + b - a, :, None] + between[None] + (flat[a:b] + beta[a:b])[:, None, :]
        pairs[: b - a] += np.exp(joint - z[: b - a, None, None])
    marginals, all_pairs, all_z = [None] * len(unary), [None] * len(unary), np.zeros(len(unary))
    for rank, k in enumerate(order):
        at = offset[: sizes[k]] + rank
        if len(at):
            marginals[k], all_pairs[k], all_z[k] = np.exp(alpha[at] + beta[at] - z[rank]), pairs[rank], z[rank]
        else:
            marginals[k], all_pairs[k] = np.zeros((0, 2)), np.zeros((2, 2))
    return marginals, all_pairs, all_z


@dataclass
class Model:
    """``weights`` (features x 2) and ``between`` (2 x 2) of the chain, state 1 being good; ``calibration`` of the document's score."""

    weights: np.ndarray
    between: np.ndarray
    calibration: np.ndarray
    constant: float | None = None

    def marginals(self, chains: list[np.ndarray]) -> list[np.ndarray]:
        sizes = np.cumsum([len(c) for c in chains])[:-1]
        unary = np.vstack([*chains, np.zeros((0, len(self.weights)))]) @ self.weights
        return forward_backward(np.split(unary, sizes), self.between)[0] if chains else []

    def document_features(self, texts: list[str | None]) -> np.ndarray:
        """Constant, length-weighted mean marginal of good lines, and length-weighted share of lines more likely bad."""
        lines = [lines_of(t) for t in texts]
        full = [k for k, x in enumerate(lines) if x]
        out = np.tile([1.0, 0.0, 1.0], (len(texts), 1))
        found = self.marginals([chain_features(line_features(lines[k])) for k in full])
        for k, m in zip(full, found, strict=True):
            size = np.array([len(x) for x in lines[k]], float)
            size /= size.sum()
            out[k] = 1.0, size @ m[:, 1], size @ (m[:, 1] < 0.5)
        return out

    def scores(self, texts: list[str | None], slice_chars: int = 4 << 20) -> list[float]:
        """Between 0 and 1; 0 for texts without a word. Takes a bounded lot of text at a time."""
        if self.constant is not None:
            return [self.constant if lines_of(t) else 0.0 for t in texts]
        out: list[float] = []
        part: list[str | None] = []
        size = 0
        for k, t in enumerate(texts):
            part.append(t)
            size += len(t or "")
            if size >= slice_chars or k == len(texts) - 1:
                x = self.document_features(part)
                some = np.array([bool(t and t.strip(" \t\n\x0b\x0c\r")) for t in part])
                out += np.where(some, 1 / (1 + np.exp(-np.clip(x @ self.calibration, -500, 500))), 0.0).tolist()
                part, size = [], 0
        return out


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    """Newton steps of a ridge-penalised logistic regression."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(rows: list[tuple[str | None, int]], rounds: int = 3, steps: int = 120, ridge: float = 1.0) -> Model:
    """Fits the chain to (text, label 0 or 1) of documents.

    Lines have no labels of their own. Those of good documents count as good;
    those of bad documents first as bad, then, in some rounds, as a plain
    classifier of lines sees them, while its likeliest bad line stays bad. The
    chain is fitted to these by gradient steps on its likelihood, and the
    document's score to the documents' labels. Without both labels in ``rows``
    the score is a constant: the share of good ones, or 0.5 without any.
    """
    rows = [(lines_of(t), int(y)) for t, y in rows]
    rows = [(x, y) for x, y in rows if x]
    good = sum(y for _, y in rows)
    k = 3 * OWN + 3
    if good in (0, len(rows)):
        return Model(np.zeros((k, 2)), np.zeros((2, 2)), np.zeros(3), good / len(rows) if rows else 0.5)
    own = [line_features(x) for x, _ in rows]
    chains = [chain_features(x) for x in own]
    sizes = np.array([len(c) for c in chains])
    cut = np.cumsum(sizes)[:-1]
    x = np.vstack(chains)
    doc_y = np.repeat([y for _, y in rows], sizes)
    line_x = np.hstack([np.vstack(own), np.ones((len(x), 1))])
    y = doc_y.astype(float)
    for _ in range(rounds):
        seen = np.split(line_x @ _logistic(line_x, y, ridge), cut)
        for part, label, new in zip(seen, (y for _, y in rows), np.split(y, cut), strict=True):
            if not label:  # new is a view into y
                new[:] = part > 0
                new[part.argmin()] = 0
    labels = np.split(y.astype(int), cut)
    onehot = np.zeros((len(x), 2))
    onehot[np.arange(len(x)), y.astype(int)] = 1
    pair = np.zeros((2, 2))
    for own_y in labels:
        np.add.at(pair, (own_y[:-1], own_y[1:]), 1)
    seen_x = x.T @ onehot
    params = np.zeros((k + 2, 2))  # weights, then between
    first, second = np.zeros_like(params), np.zeros_like(params)
    for t in range(1, steps + 1):  # Adam
        unary = np.split(x @ params[:k], cut)
        m, pairs, _ = forward_backward(unary, params[k:])
        slope = np.vstack([x.T @ np.vstack(m) - seen_x, np.sum(pairs, axis=0) - pair]) / len(x) + ridge / len(x) * params
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        params -= 0.15 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-9)
    model = Model(params[:k], params[k:], np.zeros(3))
    model.calibration = _logistic(model.document_features([b"\n".join(x).decode("utf-8", "replace") for x, _ in rows]), np.array([y for _, y in rows], float), 0.1)
    return model


def train(docs: DataFrame, labels: DataFrame, held_out: tuple[int, int] = (4, 2), max_docs: int = TRAIN_DOCS, max_chars: int = TRAIN_CHARS, max_doc_chars: int = TRAIN_DOC_CHARS) -> Model:
    """Fits on a bounded sample of labelled documents that aren't held out.

    Held out are those whose crc32 of the id modulo ``held_out[0]`` is
    ``held_out[1]``. The sample is the ``max_docs`` labelled ids with the least
    hashes, so it doesn't depend on the order of rows; its documents are read
    in the order of their hashes up to ``max_chars``. Only ``quality`` of
    ``labels`` is read. Rows without a doc_id or with another quality than 0
    or 1 aren't used; a doc_id with several labels has the least of them, one
    with several texts the least text.
    """
    mod, rest = held_out
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    ids = ids.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & (crc_mod(F.col("doc_id"), mod) != rest))
    ids = ids.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs).collect()
    quality = {r.doc_id: r.quality for r in ids}
    if not quality:
        return fit([])
    spark = docs.sparkSession
    wanted = F.broadcast(spark.createDataFrame([(i,) for i in quality], "doc_id long"))  # max_docs rows at most
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.length("text") <= max_doc_chars)
    texts = texts.join(wanted, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    size = F.sum(F.length("text")).over(_by_hash())
    rows = texts.withColumn("upto", size).where(F.col("upto") <= max_chars).orderBy(F.xxhash64("doc_id"), "doc_id").select("doc_id", "text").collect()
    return fit([(r.text, quality[r.doc_id]) for r in rows])


def _by_hash():
    from pyspark.sql import Window

    return Window.partitionBy(F.lit(0)).orderBy(F.xxhash64("doc_id"), "doc_id")  # over the sample only


def score(docs: DataFrame, model: Model, held_out: tuple[int, int] = (4, 2), threshold: float = THRESHOLD) -> DataFrame:
    """Per row: ``doc_id, held_out, score, predicted``.

    The score reads the text only. Null, empty and white texts have score 0;
    a text of any length is labelled line by line; repeated rows are scored
    each. A map without a shuffle; the model of fixed size goes along.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(ids, texts):
        s = sent.value.scores(texts)
        return ids, [crc_mod_py(i, held_out[0]) == held_out[1] for i in ids], s, [int(x >= threshold) for x in s]

    return map_rows(docs, ["doc_id", "text"], lambda: work, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score below ``threshold``; columns unchanged."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            s = sent.value.scores(batch.column("text").to_pylist())
            yield batch.filter(pa.array([x >= threshold for x in s], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def marginal_lines(docs: DataFrame, model: Model) -> DataFrame:
    """Per line with a word: ``doc_id, line_no`` (among such lines, from 0), ``n_bytes, good`` (its marginal)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(ids, texts):
        rows = []
        for i, t in zip(ids, texts, strict=True):
            if lines := lines_of(t):
                m = sent.value.marginals([chain_features(line_features(lines))])[0]
                rows += [(i, k, len(x), float(p)) for k, (x, p) in enumerate(zip(lines, m[:, 1], strict=True))]
        return list(zip(*rows, strict=True)) if rows else [[], [], [], []]

    return map_rows(docs, ["doc_id", "text"], lambda: work, "doc_id long, line_no long, n_bytes long, good double")
