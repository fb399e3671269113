import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest

from quillmark.llm import maxent


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split("[\x20\x09-\x0d]+", low) if w] + [None]


def corpus(n=240):
    r = random.Random(8)
    langs = [["the", "of", "and", "river", "stone"], ["le", "la", "et", "rivière", "PIERRE"]]
    rows = []
    for i in range(n):
        own = r.choice(langs)
        parts = [r.choice(own) + (r.choice(["tion", "ing", "", ""]) if r.random() < 0.5 else "") for _ in range(r.randrange(5, 80))]
        rows.append((i, r.choice([" ", "\n", "\t "]).join(parts)))
    return rows + [(n, None), (n + 1, ""), (n + 2, "neverseen\xa0word " * 3), (None, "the of"), (3, rows[3][1])]


@pytest.mark.parametrize("batch,part", [(1 << 24, 1 << 23), (1500, 900)])
def test_scores(spark, batch, part):
    rows = corpus()
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    count = Counter(w for i, t in rows if not held(i) for w in words(t))
    n, v = count.total(), len(count)
    df = spark.createDataFrame([(*x, 1.5) for x in rows], "doc_id long, text string, score double").repartition(3)
    got = maxent.train_and_score(df, batch_bytes=batch, part_bytes=part, top=6, rows=1 << 12).collect()
    want = Counter()
    for i, t in rows:
        w = words(t)
        want[i, held(i), len(w), sum(count[x] > 0 for x in w), n, round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    out = [r for r in got if r.held_out]
    # whole batches take many gradient steps; those of a few documents one each
    assert sum(r.score for r in out) > sum(r.base_score for r in out) * (0.95 if batch > 1e6 else 0.97)
    assert all(r.score < 0 for r in got)


def test_probabilities_sum_to_one(spark):
    rows = corpus(60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    t = maxent.train(df, top=7, rows=1 << 10)
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    count = Counter(w for i, x in rows if not held(i) for w in words(x))
    known = [b"" if w is None else w.encode() for w in count]
    leaf, share = t.tree.of(known, np.array(list(count.values())))
    assert (t.tree.n, t.tree.v) == (count.total(), len(count)) and len(t.tree.top) == 7
    history = np.array([[11, 22, 33]], np.uint64)
    of_leaf = np.exp(maxent.log_leaf(np.repeat(history, 7 + 4096, axis=0), np.arange(7 + 4096), t.tree, t.weights))
    assert of_leaf.sum() == pytest.approx(1, abs=1e-4)
    total = (of_leaf[leaf] * 10**share).sum()
    total += (of_leaf[7:] / (t.tree.tokens + t.tree.words + 1)).sum()  # and one unseen word for each class
    assert total == pytest.approx(1, abs=1e-4)


def test_paths_tell_leaves_apart():
    r = np.random.RandomState(2)
    tree = maxent.Tree.of_counts([(b"w%d" % k, 1000 // (k + 1)) for k in range(100)], r.randint(0, 5, 4096), r.randint(0, 5, 4096), 0, 0)
    which, node, branch = tree.choices(np.arange(4196))
    paths = [tuple(zip(node[which == k].tolist(), branch[which == k].tolist(), strict=True)) for k in range(4196)]
    assert len(set(paths)) == 4196 and all(p for p in paths) and np.allclose(np.exp(tree.bias).sum(axis=1), 1, atol=1e-4)
    assert len(paths[0]) <= len(paths[99]) and rare_classes_are_stable()


def rare_classes_are_stable():
    return all(0 <= maxent.rare_class(w) < 4096 for w in (b"", b"a", b"word", "рек".encode()))


def test_gradient_pass_learns():
    r = np.random.RandomState(1)
    tree = maxent.Tree.of_counts([(b"%d" % k, 50) for k in range(20)], np.zeros(4096, np.int64), np.zeros(4096, np.int64), 0, 0)
    f = np.stack([r.randint(0, 8, 6000), *(r.randint(8, 64, 6000) for _ in range(2))], axis=1).astype(np.uint64)
    leaf = (f[:, 0] % 4).astype(np.int64) * 5
    w = np.zeros((1 << 12, 16), np.float32)
    moved = maxent.gradient_pass(f, leaf, tree, w, step=200)
    assert np.exp(maxent.log_leaf(f, leaf, tree, w)).min() > 0.5 and (moved == (w != 0).any(axis=1)).all()


def test_long_text_and_empty_table(spark):
    df = spark.createDataFrame([(1, "so long a text " * 40000), (3, "so long")], "doc_id long, text string")
    assert sorted(r.n_tokens for r in maxent.train_and_score(df, batch_bytes=1 << 16).collect()) == [3, 160001]
    assert maxent.train_and_score(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_words_are_cut_as_tokens_are():
    texts = [None, "", " ", "  a B\x0bÀ\x0c\r\n c\x1c\x85\xa0d ", "x", "\t", "A\x00b \x1d \x1f", "İ ſ K", "x a"]
    batch = maxent.Batch.of_texts([3, None, *range(7)], texts, maxent.Params(3, 7, 2, 5, 1 << 14))
    got = np.split(batch.tokens, np.cumsum(batch.size)[:-1])
    assert [[batch.words[k] for k in x] for x in got] == [maxent.tokens(t) for t in texts] and len(set(batch.words)) == len(batch.words)
    assert batch.null.tolist() == [False, True] + 7 * [False] and maxent.Batch.of_texts([], [], batch.p).size.tolist() == []


def test_numbering_makes_no_object_for_each_token():
    n = 200_000
    tracemalloc.start()
    batch = maxent.Batch.of_texts(list(range(20)), ["abc de fgh ij " * (n // 80)] * 20, maxent.Params(3, 7, 2, 5, 1 << 14))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(batch.tokens) == n + 20 and peak < 40 * n  # an object and its place in a list take 44 bytes or more


def test_gradient_step_sums_what_rows_share():
    r = np.random.RandomState(5)
    tree = maxent.Tree.of_counts([(b"%d" % k, 900 // (k + 1)) for k in range(60)], r.randint(0, 5, 4096), r.randint(0, 5, 4096), 0, 0)
    f = r.randint(0, 90, (700, 3)).astype(np.uint64)
    leaf = r.randint(0, 4156, 700)
    got, want, scale = np.zeros((1 << 14, 16), np.float32), np.zeros((1 << 14, 16)), np.full(1 << 14, 1e-3)
    moved = maxent.gradient_pass(f, leaf, tree, got, step=300)
    for at in range(0, 700, 300):
        slope, times = np.zeros(want.shape), Counter()
        which, node, branch = tree.choices(leaf[at : at + 300])
        for own, k, b in zip(maxent.weight_rows(f[at : at + 300][which], node, 1 << 14), node, branch, strict=True):
            e = np.exp(want[own].sum(axis=0) + tree.bias[k])
            for row in own:
                slope[row] += e / e.sum() - (np.arange(16) == b)
                times[int(row)] += 1
        own = sorted(times)
        scale[own] += (slope[own] ** 2).mean(axis=1)
        want[own] -= slope[own] * (maxent.RATE / np.sqrt(3) / np.sqrt(scale[own]))[:, None]
        assert {1, 2, 3} <= set(times.values())
    assert np.allclose(got, want, atol=1e-3) and (moved == (scale > 1e-3)).all()


def test_classes_of_many_words():
    words = [b"", b"a", b"ab", b"word", "рек".encode(), b"\xff" * 9, b"a\x00b"]
    assert maxent.rare_classes(words).tolist() == [maxent.rare_class(w) for w in words] and maxent.rare_classes([]).tolist() == []
