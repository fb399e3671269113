import random

import pytest
from pyspark.sql import functions as F

from quillmark.functions import similarity as s
from quillmark.operators import layout, match
from quillmark.sources import documents

VOCAB = ["total", "due", "invoice", "number", "20-11", "of", "a", "Helo", "world", "Hello", "totals", "aa"]


def plain_windows(text, max_size=4):
    words = text.split()
    for size in range(1, max_size + 1):
        for i in range(len(words) - size + 1):
            if i // 400 == (i + size - 1) // 400:
                yield i, size, " ".join(words[i : i + size])


def sizes(value):
    n = len(value.split())
    return range(max(1, int(n * 0.5)), int(n * 1.5) + 1)


def corpus():
    r = random.Random(7)
    docs = [(i, " ".join(r.choice(VOCAB) for _ in range(r.choice([0, 3, 30, 410])))) for i in range(8)]
    fields = []
    for i, t in docs:
        for k, v in enumerate(["Hello world", "total due", "invoice numbr", "20 11", "", "missing value", "a a"]):
            fields.append((i, k, ["nombre", "importe_total", "glosa", "emisor_ruc", "vacio", "nada", "doble"][k], v))
    return docs, fields


@pytest.fixture(scope="module")
def tables(spark):
    docs, fields = corpus()
    w = documents.words_of_text(spark.createDataFrame(docs, "doc_id long, text string"))
    return w, spark.createDataFrame(fields, "doc_id long, field_ord int, field_name string, field_value string")


@pytest.mark.parametrize("scorer", ["ratio", "partial_ratio", "token_sort_ratio", "token_set_ratio"])
def test_fuzzy(tables, scorer):
    docs, fields = corpus()
    want = set()
    for d, t in docs:
        for i, size, window in plain_windows(t):
            for fd, k, _, v in fields:
                if fd == d and v.strip() and size in sizes(v) and (x := s.SCORERS[scorer](v.lower(), window.lower())) >= 80:
                    want.add((d, k, i, size, round(x / 100, 6)))
    got = match.fuzzy(*tables, scorer=scorer).select("doc_id", "field_ord", "start_idx", "word_count", F.round("confidence", 6)).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def best(rows):
    return max(rows, key=lambda r: (r[2], -r[1], -r[0])) if rows else None


def test_auto_and_top(tables):
    docs, fields = corpus()
    want = {}
    for d, k, _, v in fields:
        t = dict(docs)[d]
        exact = [(i, n, 1.0) for i, n, w in plain_windows(t) if v.strip() and w.lower().split() == v.lower().split()]
        near = [(i, n, s.ratio(v.lower(), w.lower()) / 100) for i, n, w in plain_windows(t) if v.strip() and n in sizes(v)]
        if hit := best(exact) or best([x for x in near if x[2] >= 0.8]):
            want[d, k] = (hit[0], hit[1], "exact" if exact else "fuzzy")
    got = {(r.doc_id, r.field_ord): (r.start_idx, r.word_count, r.match_type) for r in match.auto(*tables).collect()}
    assert got == want
    assert match.top_matches(match.fuzzy(*tables), 2).groupBy("doc_id", "field_ord").count().agg(F.max("count")).first()[0] <= 2


def normal(kind, v):
    plain = lambda x: x.lower().replace(",", "").replace(".", "").strip()
    return {"ruc": "".join(c for c in v if c.isdigit()), "number": plain(v.replace(",", "").replace(" ", "")), "text": plain(v)}[kind]


def test_weighted(tables):
    docs, fields = corpus()
    kinds = {"nombre": "text", "importe_total": "number", "glosa": "text", "emisor_ruc": "ruc", "nada": "text", "doble": "text"}
    want = {}
    for d, k, name, v in fields:
        if not v.strip():
            continue
        rows = []
        for i, n, w in plain_windows(dict(docs)[d]):
            if n in sizes(v):
                a, b = normal(kinds[name], v), normal(kinds[name], w)
                x = 100 if a == b else s.weighted(a, b) if a and b else 0
                if x >= 80:
                    rows.append((i, n, x))
        if rows:
            want[d, k] = best(rows)
    got = {(r.doc_id, r.field_ord): (r.start_idx, r.word_count, round(r.confidence * 100, 6)) for r in match.weighted(*tables).collect()}
    assert got == {key: (i, n, round(x, 6)) for key, (i, n, x) in want.items()}


def test_blank_words_and_words_with_spaces(spark):
    w = documents.words_of_text(spark.createDataFrame([(1, "a x b")], "doc_id long, text string"))
    blank = w.withColumn("text", F.when(F.col("word_idx") == 1, "​").otherwise(F.col("text")))
    spaced = w.withColumn("text", F.when(F.col("word_idx") == 1, "a b").otherwise(F.col("text")))
    f = spark.createDataFrame([(1, 0, "n", "a b")], "doc_id long, field_ord int, field_name string, field_value string")
    assert [(r.start_idx, r.end_idx) for r in match.exact(blank, f).collect()] == [(0, 2)]
    assert match.exact(spaced, f).count() == 0


def test_non_overlapping(spark):
    m = spark.createDataFrame([(1, 0, "n", i, i + 1) for i in (0, 1, 3, 4)], "doc_id long, field_ord int, field_name string, start_idx int, end_idx int")
    assert match.non_overlapping(m).first().starts == [0, 3]


def test_by_lines(spark):
    w = documents.words_of_text(spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(30)))], "doc_id long, text string"))
    f = spark.createDataFrame([(1, 0, "n", "w4 w5 w6 w7\nw8 w9")], "doc_id long, field_ord int, field_name string, field_value string")
    rows = match.routed(w, f).collect()
    assert [(r.matched_text, r.match_type) for r in rows] == [("w4 w5 w6 w7 w8 w9", "merged_multiline")]


def test_overlapping_windows(spark):
    n = spark.createDataFrame([(1, 150), (2, 77), (3, 76), (4, 10), (5, 0)], "k int, n int")
    got = {}
    for r in layout.overlapping(n).collect():
        got.setdefault(r.k, []).append((r["first"], r["end"]))
    assert {k: [a for a, _ in sorted(v)] for k, v in got.items()} == {1: [0, 51, 102], 2: [0, 51], 3: [0], 4: [0]}
    assert max(e for _, e in got[1]) == 150


def test_item_rows(spark):
    items = spark.createDataFrame([(1, 0, "ABC-1"), (1, 1, "pipe wrench"), (1, 2, "nothing"), (1, 3, "")], "doc_id long, item_idx int, key string")
    rows = spark.createDataFrame([(1, 0, 0, "code abc-1 bolt 3"), (1, 0, 1, "x pipe wrnch 9"), (1, 0, 2, "abc-1 again")], "doc_id long, page_num int, row int, text string")
    got = {r.item_idx: (r.row, r.score) for r in layout.item_rows(items, rows).collect()}
    assert got[0] == (0, 100) and got[1][0] == 1 and set(got) == {0, 1}
