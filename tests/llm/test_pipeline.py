import random

import pytest

import corpus_pipeline
from quillmark.llm import crf, piece_model, sentencepiece_ac

from . import test_crf, test_near_copies, test_spaced_seeds, test_suffix_dedup, test_tokens


def corpus():
    r = random.Random(21)
    rows = [(i, t, "en", f"src{i % 3}") for i, t, _ in test_crf.texts(160)]
    labels = [(i, y, 0) for i, _, y in test_crf.texts(160)]
    good = [t for i, t, y in test_crf.texts(160) if y and len(t.split()) > 40]
    items = [(k, " ".join(r.choice(["which", "river", "is", "longer", "than", "nine", "hundred", "miles", "north"]) for _ in range(20))) for k in range(4)]
    at = 1000
    for t in good[:12]:
        w = t.split(" ")
        rows.append((at, t, "en", "copy"))
        rows.append((at + 1, " ".join([*w[:5], "altered", *w[6:]]), "en", "near"))
        rows.append((at + 2, r.choice(good) + "\n" + " ".join(w[10:40]) + ".", "fr", "passage"))
        rows.append((at + 3, good[12] + "\nEnd of part one. " + items[at % 4][1] + " More was said.\n" + good[13] + str(at), "en", "leak"))
        at += 4
    return rows + [(2000, None, None, None), (2001, "", "en", "x")], labels, items


def plain(rows, model, items):
    rows = [r for r in rows if model.scores([r[1]])[0] >= 0.7]
    keep = {doc for doc, least in test_near_copies.plain_least([(r[0], r[1]) for r in rows]) if doc == least}
    rows = [r for r in rows if r[0] in keep]
    gone = test_suffix_dedup.plain_flags([(r[0], r[1]) for r in rows], 50)
    rows = [(i, bytes(b for b, g in zip(t.encode(), f, strict=True) if not g).decode("utf-8", "ignore"), any(f)) for (i, t, *_), f in zip(rows, gone, strict=True)]
    rows = [(i, t) for i, t, cut in rows if t.strip() or not cut]
    dirty = {x[0] for x in test_spaced_seeds.plain(rows, items, test_spaced_seeds.Rule())}
    pieces = piece_model.load(piece_model.default_model())
    return {i: test_tokens.viterbi(pieces, piece_model.SPACE + t.replace(" ", piece_model.SPACE)) for i, t in rows if i not in dirty}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    rows, labels, items = corpus()
    spark.createDataFrame([(i, t, la, s, len(t or "")) for i, t, la, s in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_run_equals_plain_version(spark, folder):
    rows, labels, items = corpus()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = crf.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    want = plain(rows, model, items)
    got = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id: list(r.piece_ids) for r in got} == want and len(got) == len(want)
    assert 40 < len(want) < len(rows) - 60 and all(r.same for r in got)


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.dtypes == spark.read.parquet(f"{folder}/documents.parquet").dtypes
    assert all(r.n_chars == len(r.text) for r in docs.collect())


def test_empty_tables_and_clashing_columns(spark, folder, tmp_path):
    """No documents give no rows, with labels and without; columns that stages use inside stay the documents' own."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    more = docs.selectExpr("*", "1 as _batch", "doc_id as key", "'x' as _ID", "2 as score")
    kept = more
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, folder)
        assert kept.columns == more.columns
    assert {r.doc_id: r.key for r in kept.collect()} == {r.doc_id: r.doc_id for r in kept.collect()} and kept.count() > 40
