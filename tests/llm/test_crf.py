import itertools
import math
import random
import zlib

import numpy as np
import pytest

from quillmark.llm import crf


def test_forward_backward_equals_all_paths():
    r = np.random.RandomState(1)
    unary = [r.randn(n, 2) for n in (1, 4, 2, 0, 4, 6)]
    between = r.randn(2, 2)
    got, pairs, z = crf.forward_backward(unary, between)
    for k, u in enumerate(unary):
        n = len(u)
        weight = {p: math.exp(sum(u[i, s] for i, s in enumerate(p)) + sum(between[a, b] for a, b in itertools.pairwise(p))) for p in itertools.product((0, 1), repeat=n)}
        total = sum(weight.values())
        if n:
            assert z[k] == pytest.approx(math.log(total))
        for i in range(n):
            assert got[k][i, 1] == pytest.approx(sum(w for p, w in weight.items() if p[i]) / total)
        for a, b in itertools.product((0, 1), repeat=2):
            assert pairs[k][a, b] == pytest.approx(sum(w * sum((x, y) == (a, b) for x, y in itertools.pairwise(p)) for p, w in weight.items()) / total)


def texts(n, seed=3):
    r = random.Random(seed)
    sylla = ["tion", "er", "an", "the", "st", "ou", "in", "al"]
    word = lambda: "".join(r.choice(sylla) for _ in range(r.randrange(1, 4)))
    line = lambda: " ".join(word() for _ in range(r.randrange(5, 30))).capitalize() + "."
    junk = [lambda: " | ".join(word() for _ in range(12)), lambda: " ".join([word()] * 30), lambda: " ".join(word() + "%%%" for _ in range(14)), lambda: " ".join(word().upper() + "!!" for _ in range(15))]
    rows = []
    for i in range(n):
        bad = r.random() < 0.3
        kind = r.choice(junk)
        rows.append((i, "\n".join([line()] + [kind() if bad else line() for _ in range(r.randrange(1, 8))]), int(not bad)))
    return rows


def test_held_out_accuracy(spark):
    rows = texts(500)
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(900, None, "x"), (901, "", "x"), (902, " \n ", "x"), (None, rows[0][1], "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in rows] + [(None, 1, 0), (3000, None, 0)], "doc_id long, quality int, toxic int")
    model = crf.train(docs, labels)
    got = {r.doc_id: r for r in crf.score(docs, model).collect()}
    assert len(got) == 504 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    assert [got[i].score for i in (900, 901, 902)] == [0, 0, 0]
    assert got[None].score == got[0].score
    out = [(got[i].predicted, y) for i, _, y in rows if got[i].held_out]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _, _ in rows)
    assert 80 < len(out) < 170 and sum(a == b for a, b in out) / len(out) > 0.95
    kept = crf.keep_good(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.predicted}
    lines = crf.marginal_lines(docs.where("doc_id < 20"), model).collect()
    assert len(lines) == sum(len(t.split("\n")) for i, t, _ in rows if i < 20) and all(0 <= x.good <= 1 for x in lines)


def test_held_out_labels_are_not_read(spark):
    rows = texts(120)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    flip = lambda i, y: 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y
    a, b = (crf.train(docs, spark.createDataFrame([(i, f(i, y)) for i, _, y in rows], "doc_id long, quality int")) for f in (lambda i, y: y, flip))
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.calibration, b.calibration)


def test_no_labels_and_no_documents(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.doc_id: r.score for r in crf.score(docs, crf.train(docs, none)).collect()} == {1: 0.5, 2: 0.0}
    assert crf.score(docs.limit(0), crf.train(docs.limit(0), none)).count() == 0


def test_long_text():
    model = crf.fit([(t, y) for _, t, y in texts(200)])
    long = "\n".join(t for _, t, y in texts(3000, 9) if y)
    assert model.scores([long])[0] > 0.7 and model.scores(["word%%% " * 200_000])[0] < 0.5
