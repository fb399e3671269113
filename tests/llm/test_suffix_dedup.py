import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from quillmark.llm import suffix_dedup as sd


def plain_flags(rows, length):
    """Removed bytes of each row, from the least doc_id of every window."""
    key = lambda i: (1 << 63) - 1 if i is None else i
    least = {}
    for doc_id, text in rows:
        raw = (text or "").encode()
        for p in range(len(raw) - length + 1):
            w = raw[p : p + length]
            least[w] = min(least.get(w, 1 << 64), key(doc_id))
    out = []
    for doc_id, text in rows:
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for p in range(len(raw) - length + 1):
            if least[raw[p : p + length]] < key(doc_id):
                gone[p : p + length] = [True] * length
        out.append(gone)
    return out


def plain(rows, length):
    out = []
    for (doc_id, text), gone in zip(rows, plain_flags(rows, length), strict=True):
        raw = (text or "").encode()
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        rest = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append((doc_id, len(raw), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return out


def corpus(seed, n=40):
    r = random.Random(seed)
    letters = "abcdé "
    passages = ["".join(r.choice(letters) for _ in range(r.randrange(45, 140))) for _ in range(6)] + ["ab" * 60, "x" * 90]
    rows = []
    for i in range(n):
        parts = [r.choice(passages) if r.random() < 0.5 else "".join(r.choice(letters) for _ in range(r.randrange(80))) for _ in range(r.randrange(6))]
        rows.append((i * 2, "".join(parts)))
    rows += [(1, rows[5][1]), (301, rows[6][1]), (301, rows[6][1]), (None, rows[7][1]), (None, rows[8][1]), (400, None), (401, ""), (402, "x" * 49), (403, "x" * 50)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,small", [(1, False), (2, True), (3, True)])
def test_removed_digest(spark, seed, small):
    rows = corpus(seed)
    df = spark.createDataFrame([(*x, 9) for x in rows], "doc_id long, text string, part int").repartition(3)
    extra = dict(batch_bytes=700, part_bytes=900, hot=3, sort_bytes=400) if small else {}
    got = [tuple(x)[:5] for x in sd.removed_digest(df, **extra).collect()]
    assert sorted(map(str, got)) == sorted(map(str, plain(rows, 50)))


@pytest.mark.parametrize("length", [32, 139])
def test_other_lengths(spark, length):
    rows = corpus(5) + [(900, "y" * 500), (901, "y" * 300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(x)[:5] for x in sd.removed_digest(df, length=length, batch_bytes=900, part_bytes=5000).collect()]
    assert sorted(map(str, got)) == sorted(map(str, plain(rows, length)))


def test_buckets_are_suffix_order():
    r = random.Random(4)
    for length in (32, 50, 64, 100):
        text = "".join(r.choice("ab") for _ in range(60)) * 9 + "".join(r.choice("abc") for _ in range(900))
        windows = np.array(sorted(r.sample(range(len(text) - length + 1), 500)))
        bucket = sd.equal_windows(text.encode(), windows, length)
        want = [text[i : i + length] for i in windows]
        rank = {w: k for k, w in enumerate(sorted(set(want)))}
        assert [rank[w] for w in want] == np.unique(bucket, return_inverse=True)[1].tolist()


def test_stretches_hold_every_window_once():
    r = random.Random(6)
    texts = ["".join(r.choice("ab") for _ in range(n)).encode() for n in (0, 49, 50, 51, 400, 3000)] + [b"z" * 700, bytes(range(256)) * 2500]
    s = sd.stretches(texts, 50)
    seen = sorted((d, a + k) for d, a, n in zip(s.doc.tolist(), s.start.tolist(), s.windows.tolist(), strict=True) for k in range(n))
    assert seen == [(d, p) for d, t in enumerate(texts) for p in range(len(t) - 49)]
    assert s.windows.max() <= 27
    gram = {}
    for d, a, n, g in zip(*(x.tolist() for x in s), strict=True):
        for k in range(n):
            assert gram.setdefault(texts[d][a + k : a + k + 50], g) == g


def test_without_repeats(spark):
    same = "a passage of well over fifty bytes that two documents have in common, word for word"
    rows = [(1, "A " + same, "x"), (2, same + " é own end", None), (3, same, "z"), (4, None, "w"), (5, " ", "v")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _batch string")
    out = sd.without_repeats(df)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect())) == [(1, "A " + same, "x"), (2, " é own end", None), (4, None, "w"), (5, " ", "v")]


def test_empty(spark):
    assert sd.removed_digest(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_hot_minimisers_are_counted_in_full():
    r = random.Random(8)
    p = sd.Params(50, 1, 600, 1 << 20)

    def batch(n, core):
        text = b"".join(bytes(r.choice(b"abcdefgh") for _ in range(40)) + core for _ in range(n)).decode()
        return sd.Batch(pa.table({"doc_id": pa.array([n]), "text": pa.array([text])}), p)

    cores = [bytes(r.choice(b"ABCDEFGH") for _ in range(24)) for _ in range(40)]
    core = max(cores, key=lambda c: np.bincount(batch(60, c).inverse).max())  # one that is the least gram around often
    one, two = batch(2000, core), batch(2001, core)
    most = [np.bincount(x.inverse).max() for x in (one, two)]
    for hot in (sum(most) - 1, sum(most)):  # 255 was the most that a batch could tell
        blobs = [next(iter(x.told()))[1] for x in (one, two)]
        many = np.unpackbits(np.frombuffer(sd._unpack(sd._part_of_gram([0, 1], blobs, int(hot))[0])[1], np.uint8), count=len(one.grams))
        assert min(most) > 255 and many.sum() == (hot < sum(most))
