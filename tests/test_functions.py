import itertools
import random

import pytest
from pyspark.sql import functions as F

from quillmark.functions import geometry as g
from quillmark.functions import similarity as s
from quillmark.functions import text
from quillmark.sources import annotations


def one(spark, column, **values):
    df = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items())) if values else spark.range(1)
    return df.select(column.alias("r")).first().r


@pytest.mark.parametrize(
    "f,given,want",
    [
        (text.normalize, "  Hello   World  ", "hello world"),
        (text.normalize, "Ａb\xa0ﬁ\n", "ab fi"),
        (text.strip_accents, "José María", "Jose Maria"),
        (text.mostly_numeric, "12345", True),
        (text.mostly_numeric, "123abc45", True),
        (text.mostly_numeric, "hello", False),
        (text.mostly_numeric, "", False),
        (text.match_text, "a​b\n c", "ab c"),
        (text.weighted_text, "Ábc, d.  E", "abc d e"),
        (text.number_text, "45,000.00", "45000.00"),
        (text.tax_id, "20-137.291 313", "20137291313"),
        (text.date_text, "01/02-2023.", "01022023"),
        (text.field_type, "precio_unitario", "ruc"),
        (text.field_type, "fecha_emision", "date"),
        (text.field_type, "importe_total", "number"),
        (text.field_type, "glosa", "text"),
        (text.lines, " a \n\n  b\r\n", ["a", "b"]),
        (text.search_variants, "a\nb", ["a\nb", "a b"]),
    ],
)
def test_text(spark, f, given, want):
    assert one(spark, f(F.col("v")), v=given) == want


def test_word_boxes(spark):
    got = one(spark, text.word_boxes(F.lit("EMPRESA SAC"), F.lit(100.0), F.lit(300.0)))
    assert [tuple(x) for x in got] == [("EMPRESA", 100, 236), ("SAC", 241, 300)]
    assert [tuple(x) for x in one(spark, text.word_boxes(F.lit("x"), F.lit(1.0), F.lit(3.0)))] == [("x", 1, 3)]


def test_label_pattern():
    import re

    p = text.label_pattern("emisor_ruc").replace("(?iu)", "(?i)")
    assert all(re.search(p, x) for x in ("RUC:", "R.U.C.", "registro")) and not re.search(p, "zzz")


def b(*v):
    return g.box(*(F.lit(float(x)) for x in v))


@pytest.mark.parametrize(
    "column,want",
    [
        (lambda: F.array(g.width(b(10, 20, 50, 60)), g.height(b(10, 20, 50, 60)), g.center_x(b(10, 20, 50, 60)), g.center_y(b(10, 20, 50, 60)), g.area(b(10, 20, 50, 60))), [40, 40, 30, 40, 1600]),
        (lambda: g.as_xywh(b(10, 20, 50, 60)), [10, 20, 40, 40]),
        (lambda: g.scaled(b(50, 100, 150, 200), F.lit(500.0), F.lit(500.0)), (100, 200, 300, 400)),
        (lambda: g.scaled(b(1, 1, 2, 2), F.lit(0.0), F.lit(5.0)), None),
        (lambda: g.expanded(b(10, 10, 20, 20), 5.0), (5, 5, 25, 25)),
        (lambda: g.expanded(b(10, 10, 20, 20), 5.0, 10.0), (9, 9, 21, 21)),
        (lambda: g.intersection_area(b(0, 0, 10, 10), b(5, 5, 15, 15)), 25),
        (lambda: g.iou(b(0, 0, 10, 10), b(0, 0, 10, 10)), 1),
        (lambda: g.intersects(b(0, 0, 1, 1), b(1, 1, 2, 2)), True),
        (lambda: g.layout_box(b(10, 10, 10, 10), F.lit(100.0), F.lit(100.0)), (100, 100, 101, 101)),
        (lambda: g.layout_box(b(100, 0, 100, 1), F.lit(100.0), F.lit(100.0)), (1000, 0, 1000, 10)),
        (lambda: g.layout_box_safe(b(1, 1, 2, 2), F.lit(0.0), F.lit(1.0)), ((0, 0, 1, 1), False)),
        (lambda: g.link(F.lit(0), F.lit(1)), [[0, 1]]),
        (lambda: g.link(F.lit(None).cast("int"), F.lit(1)), []),
        (lambda: g.box_findings(b(10, 10, 13, 13)), ["area"]),
    ],
)
def test_geometry(spark, column, want):
    plain = lambda x: tuple(map(plain, x)) if isinstance(x, tuple) else x
    got = one(spark, column())
    assert (plain(got) if isinstance(got, tuple) else got) == want


def test_merged(spark):
    df = spark.createDataFrame([((10.0, 10.0, 20.0, 20.0),), ((15.0, 12.0, 30.0, 18.0),), ((11.0, 11.0, 12.0, 30.0),)], "b struct<x0: double, y0: double, x1: double, y1: double>")
    assert tuple(df.select(g.merged(F.col("b"))).first()[0]) == (10, 10, 30, 30)


def table_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_similarity_against_plain_lcs():
    r = random.Random(1)
    for _ in range(400):
        x, y = ("".join(r.choice("ab c") for _ in range(r.randrange(12))) for _ in range(2))
        assert s.lcs(x, y) == table_lcs(x, y)
        short, long = sorted((x, y), key=len)
        if short:
            ways = [(short, long)] if len(x) != len(y) else [(x, y), (y, x)]
            stretches = lambda a, b: [b[i:j] for i, j in itertools.combinations(range(len(b) + 1), 2) if j - i == len(a) or (j - i < len(a) and (i == 0 or j == len(b)))]
            want = max(200 * table_lcs(a, t) / (len(a) + len(t)) for a, b2 in ways for t in stretches(a, b2))
            assert s.partial_ratio(x, y) == pytest.approx(want)


def test_weighted_bounds_lose_nothing():
    r = random.Random(2)
    for _ in range(1500):
        x, y = (" ".join("".join(r.choice("abcd") for _ in range(r.randrange(1, 5))) for _ in range(r.randrange(4))) for _ in range(2))
        if r.random() < 0.5:
            y = x[: r.randrange(len(x) + 1)] + r.choice(["", "z", " q"])
        want = max(w * f(x, y) for w, f in zip(s.WEIGHTS.values(), (s.ratio, s.partial_ratio, s.token_sort_ratio, s.token_set_ratio), strict=True))
        assert s.weighted(x, y) == pytest.approx(want)
        assert s.weighted(x, y, 80) == pytest.approx(want if want >= 80 else 0)


def test_known_ratios():
    assert s.ratio("Hello", "Helo") == pytest.approx(88.889, abs=0.001)
    assert s.ratio("20-137-291-313", "20137291313") == 88 and s.ratio("", "") == 100


def test_flatten():
    value = {"address": {"street": "x", "city": None}, "items": [{"a": 1}, 2.5, [1, 2]], "none": {}, "flag": True, "skip": 1, "deep": {"skip": {"a": 1}, "k": "v"}}
    assert annotations.flatten(value, ["skip"]) == {"address.street": "x", "address.city": "", "items[0].a": "1", "items[1]": "2.5", "items[2]": "[1, 2]", "flag": "True", "deep.k": "v"}


def test_fields_of_bad_json(spark):
    df = spark.createDataFrame([(1, '{"a": {"b": 1}}'), (2, "no json"), (3, None), (4, "[1]")], "doc_id long, json string")
    assert [tuple(r) for r in annotations.fields(df).collect()] == [(1, 0, "a.b", "1")]


def test_partial_ratio_skips_stretches_that_the_last_one_rules_out(monkeypatch):
    r = random.Random(4)
    text = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    calls, plain = [], s._lcs
    monkeypatch.setattr(s, "_lcs", lambda *x: calls.append(1) or plain(*x))
    for _ in range(40):
        short, long = text(20), text(120)
        stretches = [long[max(0, k - 20) : k] for k in range(1, 140)]
        want = max(200.0 * s.lcs(short, x) / (20 + len(x)) for x in stretches)
        assert s.partial_ratio(short, long) == pytest.approx(want)
        calls.clear()
        got = s.partial_ratio(short, long, 80.0)
        assert got == pytest.approx(want) if want >= 80 else got < 80
        assert len(calls) < 50  # of 139 stretches
