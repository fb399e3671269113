import random

import numpy as np
import pytest
import xxhash

from quillmark.llm import components, simhash


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", low) if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(rows, bits):
    n, parent = len(rows), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= bits:
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least.setdefault(find(i), []).append(doc)
    return {(doc, f"{fp:016x}", min((x for x in least[find(i)] if x is not None), default=None)) for i, (doc, fp) in enumerate(rows)}


def texts(n):
    r = random.Random(2)
    out = []
    for _ in range(n):
        base = [r.choice("alpha beta gamma delta Épsilon zeta eta theta".split()) + str(r.randrange(30)) for _ in range(r.choice([0, 1, 2, 3, 50, 400]))]
        for _ in range(r.choice([1, 2, 6])):
            copy = list(base)
            if copy and r.random() < 0.7:
                copy[r.randrange(len(copy))] = "CHANGED"
            out.append(r.choice([" ", "\n", "\t "]).join(copy))
    return out


@pytest.mark.parametrize("long_list", [2048, 3])
def test_near_duplicates(spark, long_list):
    found = [*texts(60), None, "", "Same Text here", "same text here"]
    rows = [(i * 3 + 1, t) for i, t in enumerate(found)] + [(1, found[0]), (None, found[4])]
    df = spark.createDataFrame([(*x, 0) for x in rows], "doc_id long, text string, fp int")
    want = plain_components([(i, plain_fingerprint(t)) for i, t in rows], 2)
    got = simhash.near_duplicates(df, long_list=long_list).collect()
    assert len(got) == len(rows) and {tuple(r) for r in got} == want


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_links_find_all(spark, bits):
    r = random.Random(bits)
    fps = set()
    for _ in range(40):
        x = r.getrandbits(64)
        fps.add(x)
        for _ in range(r.randrange(12)):
            for _ in range(r.randrange(1, 3)):
                x ^= 1 << r.randrange(64)
            fps.add(x)
    signed = [simhash._signed(x) for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    want = plain_components([(simhash._signed(x), x) for x in fps], bits)
    for long_list in (2048, 3):
        roots = {r.node: r.root for r in components.components(simhash.links(df, bits, long_list)).collect()}
        assert {(x, roots.get(x, x)) for x in signed} == {(a, c) for a, _, c in want}


def test_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components.components(edges).collect()}
    assert got == {i: 0 for i in range(201)} | {500: 500, 501: 500}


def test_one_of_each(spark):
    long = " ".join(f"w{i}" for i in range(300))
    df = spark.createDataFrame([(2, long, "a"), (1, long, "b"), (3, "other words entirely here", "c"), (1, long, "b"), (None, long, "d")], "doc_id long, text string, lang string")
    out = simhash.one_of_each(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id or 0, r.lang) for r in out.collect()) == [(0, "d"), (1, "b"), (3, "c")]


def test_one_id_with_two_texts(spark):
    long = " ".join(f"w{i}" for i in range(300))
    df = spark.createDataFrame([(1, long, "a"), (5, long, "b"), (5, "something else that no other document says", "c")], "doc_id long, text string, _hash string")
    assert sorted((r.doc_id, r["_hash"]) for r in simhash.one_of_each(df).collect()) == [(1, "a"), (5, "c")]


def test_empty(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_merge_of_places():
    roots = np.arange(6)
    simhash.merge(roots, np.array([5, 3, 4]), np.array([4, 2, 2]))
    assert roots.tolist() == [0, 1, 2, 2, 2, 2]
