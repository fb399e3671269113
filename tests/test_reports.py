import json

import pytest
from pyspark.sql import functions as F

from quillmark import config
from quillmark.functions import text
from quillmark.operators import export, layout, match, reports
from quillmark.sources import documents


@pytest.fixture(scope="module")
def found(spark):
    words = documents.words_of_text(spark.createDataFrame([(1, "Total: due 45 now " + " ".join(f"w{i}" for i in range(420))), (2, "")], "doc_id long, text string"))
    fields = spark.createDataFrame([(1, 0, "total", "45"), (1, 1, "nota", "w410 w411"), (1, 2, "nada", "zzz"), (1, 3, "blank", "  "), (1, 4, "none", ""), (2, 0, "total", "7")], "doc_id long, field_ord int, field_name string, field_value string")
    return words, fields, match.first_match(match.exact(words, fields, contiguous=True))


def test_forms(found):
    words, fields, matches = found
    rows = {r.doc_id: r for r in reports.native_forms(matches, fields).collect()}
    one = rows[1]
    assert (one.total_fields, one.found, one.match_rate, one.mean_confidence, one.missing) == (3, 2, 66.67, 1.0, ["blank", "nada"])
    assert [(x.id, x.label, x.text, x.page) for x in one.form] == [(0, "total", "45", 0), (1, "nota", "w410 w411", 1)]
    assert (rows[2].found, rows[2].match_rate, rows[2].form, rows[2].missing) == (0, 0.0, [], ["total"])
    assert {(r.doc_id, r.field_name) for r in reports.missing_fields(fields, matches).collect()} == {(1, "nada"), (1, "blank"), (2, "total")}
    labelled = layout.nearest_label(matches.withColumn("box", F.col("bbox")), words.withColumn("box", F.col("bbox")), {"total": "^due$"})
    linked = reports.linked_forms(layout.form_items(labelled)).collect()[0]
    assert (linked.n_items, linked.n_labels, linked.n_words) == (3, 1, 4)
    whole = json.loads(reports.as_json(reports.native_forms(matches, fields)).where("doc_id = 1").first().json)
    assert whole["form"][0]["label"] == "total" and whole["missing"] == ["blank", "nada"]


def test_forms_of_nothing(found):
    words, fields, matches = found
    assert reports.native_forms(matches.limit(0), fields.limit(0)).count() == 0
    assert reports.validation_metrics(matches.limit(0).withColumn("box", F.array(F.lit(1.0)))).first().fields_per_document is None


def test_verdicts(found):
    m = found[2]
    assert {r.verdict: r.n for r in reports.reject_counts(m).collect()} == {"kept": 2}
    assert {r.verdict: r.n for r in reports.reject_counts(m, min_area=500).collect()} == {"invalid_box": 1, "kept": 1}
    low = m.withColumn("confidence", F.lit(None).cast("double"))
    assert {r.verdict for r in reports.reject_counts(low).collect()} == {"low_confidence"} and reports.kept(low).count() == 0


def test_counts(spark):
    rows = spark.createDataFrame([(1, None), (2, "x"), (3, None)], "doc_id long, error string")
    assert reports.batch_rollup(rows).first()[:] == (3, 2, 1, 100 * 2 / 3)
    assert reports.batch_rollup(rows.limit(0)).first().success_rate is None
    words = spark.createDataFrame([(1, 0, "native"), (1, 1, "ocr"), (2, 0, "native"), (2, 0, "native")], "doc_id long, page_num int, source string")
    assert {r.method: r.documents for r in reports.method_counts(words).collect()} == {"native": 2, "ocr": 1}
    assert [tuple(r) for r in reports.top_documents(words, 1).collect()] == [(1, 2)]
    files = spark.createDataFrame([("a.json", True), ("b.json", False), ("c.json", None)], "stem string, valid boolean")
    assert [r.stem for r in reports.unreadable(files).orderBy("stem").collect()] == ["b.json", "c.json"]


def test_inventory_and_cache(spark):
    left = spark.createDataFrame([("/p/a.pdf", 5), ("/p/b.pdf", 7)], "path string, size long")
    right = spark.createDataFrame([("/j/a.json",), ("/k/a.json",)], "path string")
    assert documents.inventory(left, right).first()[:] == (2, 1, 1, 5, 7)
    pages = left.select("path", F.lit(0).alias("page_num"), F.lit("ocr").alias("source"))
    empty = spark.createDataFrame([], "path string, key string, size long")
    new = documents.cache_additions(pages.unionByName(pages.withColumn("source", F.lit("native"))), empty)
    assert new.count() == 2
    held = new.where("path = '/p/a.pdf'").select("path", "key", F.lit(9).alias("size"))
    s = documents.cache_stats(pages, held, F.col("size")).first()
    assert (s.hits, s.misses, s.entries, s.bytes, s.hit_rate) == (1, 1, 1, 9, 50.0)
    assert documents.cache_additions(pages, held).count() == 1 and documents.cache_without(held, "/p/a.pdf").count() == 0
    assert documents.cache_stats(pages.limit(0), empty, F.col("size")).first().hit_rate == 0


def test_exports_are_read_back(spark, tmp_path):
    (tmp_path / "a_out.json").write_text('{"total": 3,\n "name": "x"}')
    (tmp_path / "other.txt").write_text("{}")
    row = documents.read_exports(spark, str(tmp_path), "*_out.json").first()
    assert (row.stem, row.total, row.name) == ("a_out", 3, "x")


def test_pages_pictures_previews(found, spark):
    words, fields, matches = found
    page = export.picture_rows(matches).where("page_num = 0").first()
    assert (page.width, page.height, page.fields[0].name, page.fields[0].text) == (612.0, 792.0, "total", "45") and len(page.fields[0].color) == 7
    parts = {(r.part, r.page_num, r.chunk): r["count"] for r in reports.multipage_parts(words, ["word_idx"]).groupBy("part", "page_num", "chunk").count().collect()}
    assert parts == {("header", 0, 0): 192, ("header", 0, 1): 192, ("header", 0, 2): 16, ("items", 1, 0): 24}
    both, alone = reports.pages_with_images(matches.select("doc_id", "page_num"), spark.createDataFrame([(1, "a.png")], "doc_id long, image string"))
    assert both.count() == 2 and alone.count() == 0
    long = fields.limit(1).withColumn("field_value", F.lit("x" * 60))
    assert reports.structure_preview(long).first().preview == "x" * 50 + "..."
    hits = spark.createDataFrame([("a\nb",), ("a",)], "text string")
    assert {r.text: r.match_type for r in reports.hits_as_matches(hits).collect()} == {"a\nb": "multiline", "a": "exact"}


@pytest.mark.parametrize("fmt", ["json", "csv", "layoutlm", "coco", "yolo", "pascal_voc"])
def test_every_format_has_rows(found, fmt):
    assert export.as_format(found[2], fmt).count() >= 1


def test_formats_that_do_not_exist(found):
    with pytest.raises(ValueError):
        export.as_format(found[2], "bmp")


def test_settings_go_both_ways():
    given = {"matcher": {"strategy": "exact", "fuzzy_threshold": 70.0}, "log_level": "DEBUG", "what": 1}
    before = json.dumps(given)
    own = config.settings(given)
    assert json.dumps(given) == before and "what" not in own
    assert own["matcher"]["strategy"] == "exact" and own["matcher"]["use_multiline"] and own["log_level"] == "DEBUG"
    assert config.settings(own) == own and config.settings() == config.settings({}) == config.DEFAULTS
    for bad in ({"matcher": {"strategy": "guess"}}, {"matcher": {"speed": 1}}, {"exporter": {"format": "bmp"}}):
        with pytest.raises(ValueError):
            config.settings(bad)


def test_settings_decide_the_match(found):
    words, fields, _ = found
    total = fields.where("doc_id = 1 and field_ord = 0").withColumn("field_value", F.lit("TOTAL"))
    by = lambda **more: config.align(words, total, config.settings({"matcher": {"strategy": "exact"} | more.pop("matcher", {}), **more})).count()
    assert by() == 0  # the word is "Total:"
    assert by(normalizer={"remove_punctuation": True}) == 1
    assert by(normalizer={"remove_punctuation": True}, matcher={"strategy": "exact", "case_sensitive": True}) == 0


def test_presets(spark):
    row = spark.range(1).select(*(text.normalize(F.lit("A-b, C"), **text.PRESETS[n]).alias(n) for n in ("default", "strict", "fuzzy"))).first()
    assert (row.default, row.strict, row.fuzzy) == ("a-b, c", "a-b, c", "ab c")
