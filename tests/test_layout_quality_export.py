import json
import subprocess
import sys
import xml.etree.ElementTree as ET
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quillmark import streaming
from quillmark.operators import export, layout, match, quality
from quillmark.plans import registry
from quillmark.sources import annotations, documents

ROOT = Path(__file__).resolve().parent.parent
BOX = "struct<x0: double, y0: double, x1: double, y1: double>"


@pytest.fixture(scope="module")
def words(spark):
    text = "Invoice number A1 total 45 due " + " ".join(f"w{i}" for i in range(420))
    return documents.words_of_text(spark.createDataFrame([(1, text), (2, ""), (3, None)], "doc_id long, text string"))


@pytest.fixture(scope="module")
def matches(spark, words):
    f = spark.createDataFrame([(1, 0, "numero", "A1"), (1, 1, "total", "45"), (1, 2, "nota", "w410 w411"), (1, 3, "nada", "zzz"), (2, 0, "numero", "x"), (2, 1, "vacio", "")], "doc_id long, field_ord int, field_name string, field_value string")
    return f, match.first_match(match.exact(words, f))


def test_words(words):
    rows = words.orderBy("word_idx").collect()
    assert len(rows) == 426 and {r.page_num for r in rows} == {0, 1} and all(r.doc_id == 1 for r in rows)


def test_form_items_link_both_ways_from_id_0(spark, matches, words):
    got = layout.form_items(layout.nearest_label(matches[1].withColumn("box", F.col("bbox")), words.withColumn("box", F.col("bbox")), {"numero": "(?i)^number$", "total": "(?i)^total$"})).collect()
    by = {r.id: r for r in got}
    assert sorted(by) == list(range(5))
    assert (by[0].kind, by[0].text, by[0].linking) == ("question", "number", [[0, 1]]) and by[1].linking == [[0, 1]]
    assert (by[4].kind, by[4].text, by[4].linking) == ("answer", "w410 w411", [])


def test_bio(matches, words):
    tags = {r.text: r.tag for r in layout.bio_tags(words, matches[1]).collect()}
    assert tags["A1"] == "B-numero" and tags["w410"] == "B-nota" and tags["w411"] == "I-nota" and tags["due"] == "O"


def test_stats(matches):
    s = {r.doc_id: r for r in quality.document_stats(*matches).collect()}
    assert (s[1].total, s[1].matched, s[1].unmatched, s[1].pages) == (4, 3, 1, [0, 1]) and s[1].match_rate == 75
    assert (s[2].matched, s[2].match_rate, s[2].pages, s[2].mean_confidence) == (0, 0, [], None)


@pytest.mark.parametrize(
    "box,text,confidence,page,kinds",
    [
        ([1.0, 2.0, 3.0], "x", 0.9, 0, {"box_size"}),
        ([0.0, 0.0, 1.0, 1.0], "x", 0.9, 0, {"box_unit_scale", "box_area"}),
        ([10.0, 10.0, 1200.0, 50.0], "x", 0.9, 0, {"box_range"}),
        ([10.0, 10.0, 13.0, 13.0], "x", 0.9, 0, {"box_area"}),
        ([10.0, 10.0, 910.0, 20.0], "x", 0.9, 0, {"box_aspect"}),
        ([10.0, 10.0, 60.0, 40.0], "  ", 0.9, 0, {"text_empty"}),
        ([10.0, 10.0, 60.0, 40.0], "x", 0.69, 0, {"confidence_low"}),
        ([10.0, 10.0, 60.0, 40.0], "x", None, None, {"confidence_type", "page_missing"}),
        ([10.0, 10.0, 60.0, 40.0], None, 0.9, -1, {"page_invalid", "text_empty"}),
        ([10.0, 10.0, 60.0, 40.0], "x", 0.9, 0, set()),
        (None, "x", 0.9, 0, {"box_size"}),
    ],
)
def test_rules(spark, box, text, confidence, page, kinds):
    df = spark.createDataFrame([(1, 0, box, text, confidence, page)], "doc_id long, field_ord int, box array<double>, text string, confidence double, page_num int")
    assert {r.kind for r in quality.issues(df).collect()} == kinds


def test_summary_without_documents(spark):
    none = spark.createDataFrame([], "doc_id long, field_ord int, box array<double>, text string, confidence double, page_num int")
    row = quality.validation_summary(none, quality.issues(none)).first()
    assert row.documents == 0 and row.fit_for_training is False


def test_exports_come_back(spark, matches, tmp_path):
    m = matches[1]
    export.write(export.csv_rows(m), f"{tmp_path}/csv", "csv")
    assert {(r.field_name, r.text) for r in spark.read.csv(f"{tmp_path}/csv", header=True).collect()} == {("numero", "A1"), ("total", "45"), ("nota", "w410 w411")}
    export.write(export.voc_rows(m), f"{tmp_path}/voc", "voc")
    pages = spark.read.text(f"{tmp_path}/voc").collect()
    assert len(pages) == 2 and {o.text for p in pages for o in ET.fromstring(p.value).iter("name")} == {"numero", "total", "nota"}
    export.write(export.yolo_rows(m, ["x", "total"]), f"{tmp_path}/yolo", "yolo")
    assert sorted(r.value.split()[0] for r in spark.read.text(f"{tmp_path}/yolo").collect()) == ["0", "0", "1"]
    one = json.loads(export.json_rows(m).first().json)
    assert one["total_fields"] == 3 and one["annotations"][0]["field_name"] == "numero"
    assert export.categories(m).collect()[0].category_id == 1 and export.coco_images(m).count() == 2


def test_hybrid_prefers_ocr_only_when_it_has_more(spark):
    row = lambda d, n, c: [(d, 0, i, f"t{i}", c) for i in range(n)]
    schema = "doc_id long, page_num int, word_idx int, text string, confidence double"
    native = spark.createDataFrame(row(1, 5, 1.0) + row(2, 5, 1.0) + row(3, 50, 1.0) + row(4, 3, 1.0), schema)
    ocr = spark.createDataFrame(row(1, 6, 0.9) + row(2, 5, 0.9) + row(3, 60, 0.9) + row(4, 9, 0.4), schema)
    kinds = spark.createDataFrame([(1, 0, "native"), (2, 0, "native"), (3, 0, "native"), (4, 0, "rasterized")], "doc_id long, page_num int, kind string")
    got = {r.doc_id: (r.method, r["n"]) for r in documents.hybrid_words(native, ocr, kinds).groupBy("doc_id", "method").agg(F.count("*").alias("n")).collect()}
    assert got == {1: ("ocr", 6), 2: ("native", 5), 3: ("native", 50), 4: ("native", 3)}


def test_annotation_files_and_pairs(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"emisor": {"ruc": "20-1"}, "items": [{"codigo": "x"}]}')
    (tmp_path / "b.json").write_text("no json")
    rows = {r.stem: r for r in documents.read_annotations(spark, str(tmp_path)).collect()}
    assert rows["a"].valid and not rows["b"].valid
    df = spark.createDataFrame([(1, rows["a"].json)], "doc_id long, json string")
    assert [r.item.codigo for r in annotations.items(df, "struct<codigo: string>").collect()] == ["x"]
    assert annotations.fields(df).count() == 2


def test_extractor_failures_become_rows(spark):
    import pandas as pd

    def extract(content):
        if content == b"bad":
            raise ValueError("no document")
        return pd.DataFrame([{"text": content.decode()}])

    files = spark.createDataFrame([("a", b"ok"), ("b", b"bad")], "path string, content binary")
    got = {r.path: (r.text, r.error) for r in documents.extract_with(files, extract, "text string").collect()}
    assert got == {"a": ("ok", None), "b": (None, "ValueError: no document")}


def test_stream(spark, tmp_path):
    spark.createDataFrame([(1, "a b c", "en", "s", 5), (2, None, "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/in")
    streaming.each_batch(streaming.documents(spark, f"{tmp_path}/in"), documents.words_of_text, f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination(60)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3


def test_every_oracle_has_a_query():
    assert set(registry.ORACLES) <= set(registry.QUERIES) and len(registry.QUERIES) > 70


def test_rest_works_without_the_language_model_folders(tmp_path):
    import shutil

    for name in ("quillmark", "__spark_entry__.py"):
        (shutil.copytree if (ROOT / name).is_dir() else shutil.copy)(ROOT / name, tmp_path / name)
    shutil.rmtree(tmp_path / "quillmark" / "llm", ignore_errors=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'exact_best' in q and not any(k.startswith('op') or k == 'pipeline' for k in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
