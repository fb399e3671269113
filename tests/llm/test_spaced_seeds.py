import random
import re

import pytest

from quillmark.llm import spaced_seeds
from quillmark.llm.spaced_seeds import Rule


def toks(text):
    return re.findall("[0-9a-z\x80-\U0010ffff]+", (text or "").lower())


def plain(docs, items, rule):
    """All alignments, each compared in full."""
    out = set()
    for doc_id, text in docs:
        d = toks(text)
        for item_id, want in items:
            w = toks(want)
            for shift in range(-len(w) + 1, len(d)):
                eq = [(k, d[k + shift] == w[k]) for k in range(len(w)) if 0 <= k + shift < len(d)]
                at = [k for k, e in eq if e]
                best = None
                for i in range(len(at)):
                    for j in range(i, len(at)):
                        n = at[j] - at[i] + 1
                        if j - i + 1 >= rule.min_share * n - 1e-9 and (best is None or n > best[0]):
                            best = (n, at[i], j - i + 1)
                if best and best[0] >= min(rule.min_tokens, len(w)):
                    out.add((doc_id, item_id, best[1] + shift, best[1], best[0], best[2]))
    return out


def corpus(seed):
    r = random.Random(seed)
    vocab = [f"word{i}" for i in range(60)] + ["Éa", "b2", "the"] * 4
    items = [(i, " ".join(r.choice(vocab) for _ in range(r.choice([1, 3, 8, 14, 25, 40])))) for i in range(12)] + [(98, None), (99, "")]
    docs = []
    for i in range(60):
        parts = [r.choice(vocab) for _ in range(r.randrange(60))]
        if r.random() < 0.7:
            copy = r.choice(items[:12])[1].split()
            for _ in range(r.randrange(1 + len(copy) // 5)):
                copy[r.randrange(len(copy))] = "changed"
            cut = r.randrange(len(parts) + 1)
            parts = parts[:cut] + copy[r.randrange(3) :] + parts[cut:]
        docs.append((i, r.choice([" ", ", ", "\n"]).join(parts).upper()))
    return [*docs, (100, None), (101, ""), (5, docs[5][1])], items


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_overlaps(spark, seed):
    docs, items = corpus(seed)
    d = spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, item_id int")
    b = spark.createDataFrame(items, "item_id long, text string")
    for block in (1 << 20, 300):
        got = {tuple(r) for r in spaced_seeds.overlaps(d, b, Rule(), block).collect()}
        assert got == plain(docs, items, Rule())
    dirty = {x[0] for x in got}
    kept = spaced_seeds.without_overlaps(d, b, Rule(), 300)
    assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == sorted(i for i, _ in docs if i not in dirty)


def test_empty_tables(spark):
    none, no_items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    one, item = spark.createDataFrame([(1, "a b c")], "doc_id long, text string"), spark.createDataFrame([(1, "a b c"), (None, "a b c")], "item_id long, text string")
    assert spaced_seeds.overlaps(none, item).count() == 0 and spaced_seeds.overlaps(one, no_items).count() == 0
    assert [tuple(r) for r in spaced_seeds.overlaps(one, item).collect()] == [(1, 1, 0, 0, 3, 3)]
    assert spaced_seeds.without_overlaps(one, no_items).count() == 1


def test_long_text(spark):
    text = "filler word " * 200_000 + "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    d = spark.createDataFrame([(1, text)], "doc_id long, text string")
    b = spark.createDataFrame([(7, "one two three four five six CHANGED eight nine ten eleven twelve thirteen fourteen")], "item_id long, text string")
    assert [tuple(r) for r in spaced_seeds.overlaps(d, b).collect()] == [(1, 7, 400_000, 0, 14, 13)]


def test_scripts_without_spaces_and_marks(spark):
    assert spaced_seeds.tokens("Über “die” Brücke—dort") == ["über".encode(), b"die", "brücke".encode(), b"dort"]
    leaked = "这座桥是在很久以前由当地的工匠用石头建造的"
    docs = spark.createDataFrame([(1, "前言。" + leaked + "，后来它倒了。"), (2, "这条河很长，很多人住在河边的村子里，他们每天都去打鱼。"), (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(None, leaked)], "item_id long, text string")
    assert {r.doc_id for r in spaced_seeds.without_overlaps(docs, bench).collect()} == {2, 3} and spaced_seeds.overlaps(docs, bench).count() == 0
