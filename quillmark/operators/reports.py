"""Reports over documents: counts, roll-ups and first rows, and the forms with their statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as g
from .layout import chunks, split_words


def method_counts(words: DataFrame, method: str = "source") -> DataFrame:
    """Documents that have words by each extraction method; a document counts for each of its methods."""
    return words.select("doc_id", F.col(method).alias("method")).distinct().groupBy("method").agg(F.count("*").alias("documents"))


def batch_rollup(outcomes: DataFrame) -> DataFrame:
    """One row from ``doc_id, error`` (null: it went well): documents, ok, failed, rate in percent (null for none)."""
    out = outcomes.agg(F.count("*").alias("documents"), F.count_if(F.col("error").isNull()).alias("ok"), F.count_if(F.col("error").isNotNull()).alias("failed"))
    return out.withColumn("success_rate", F.try_divide(100 * F.col("ok"), F.col("documents")))


def failures(outcomes: DataFrame) -> DataFrame:
    return outcomes.where(F.col("error").isNotNull()).select("doc_id", "error")


def top_documents(words: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` documents with most pages; the least id first among equals."""
    n = words.groupBy("doc_id").agg(F.count_distinct("page_num").alias("pages"))
    return n.orderBy(F.desc("pages"), "doc_id").limit(k)


def first_issues(found: DataFrame, k: int = 50) -> DataFrame:
    return found.orderBy("doc_id", "field_ord", "kind").limit(k)


def unreadable(annotations: DataFrame) -> DataFrame:
    """Issue rows of annotations that don't parse (``stem, valid``)."""
    return annotations.where(~F.coalesce("valid", F.lit(False))).select("stem", F.lit("unreadable").alias("kind"), F.lit("error").alias("severity"))


def validation_metrics(items: DataFrame) -> DataFrame:
    """One row: fields a document, and mean, least and largest confidence and box area (of boxes with four sides)."""
    b = [F.element_at("box", k) for k in (1, 2, 3, 4)]
    area = F.when(F.size("box") == 4, (b[2] - b[0]) * (b[3] - b[1]))
    rows = items.select("doc_id", F.col("confidence").alias("c"), area.alias("a"))
    three = [f(x).alias(f"{n}_{name}") for x, name in (("c", "confidence"), ("a", "area")) for f, n in ((F.avg, "mean"), (F.min, "min"), (F.max, "max"))]
    out = rows.agg(F.count("*").alias("fields"), F.count_distinct("doc_id").alias("documents"), *three)
    return out.withColumn("fields_per_document", F.try_divide(F.col("fields"), F.col("documents")))


def judged(matches: DataFrame, min_confidence: float = 0.7, min_area: int = 10) -> DataFrame:
    """Matches with ``verdict``: low_confidence, else invalid_box (by its 0..1000 box), else kept. A map without a shuffle."""
    valid = g.layout_box_safe(F.col("bbox"), F.col("page_width"), F.col("page_height"), min_area)["valid"]
    sure = F.coalesce(F.col("confidence") >= min_confidence, F.lit(False))
    return matches.withColumn("verdict", F.when(~sure, "low_confidence").when(~valid, "invalid_box").otherwise("kept"))


def kept(matches: DataFrame, min_confidence: float = 0.7, min_area: int = 10) -> DataFrame:
    return judged(matches, min_confidence, min_area).where(F.col("verdict") == "kept").drop("verdict")


def reject_counts(matches: DataFrame, min_confidence: float = 0.7, min_area: int = 10) -> DataFrame:
    return judged(matches, min_confidence, min_area).groupBy("verdict").agg(F.count("*").alias("n"))


def missing_fields(fields: DataFrame, matches: DataFrame) -> DataFrame:
    """Fields with a value (blanks count as one) that weren't found."""
    return fields.where(F.col("field_value") != "").join(matches.select("doc_id", "field_ord"), ["doc_id", "field_ord"], "left_anti").select("doc_id", "field_ord", "field_name")


def _statistics(fields: DataFrame, matches: DataFrame, *more: Column) -> DataFrame:
    """Fields and their matches joined once and gathered by document."""
    rows = fields.select("doc_id", "field_ord", "field_name", "field_value").join(matches.drop("field_name"), ["doc_id", "field_ord"], "left")
    found = F.col("confidence").isNotNull()
    gone = F.when(~found & (F.col("field_value") != ""), F.col("field_name"))
    out = rows.groupBy("doc_id").agg(F.count_if(F.trim("field_value") != "").alias("total_fields"), F.count_if(found).alias("found"), F.avg("confidence").alias("mean"), F.array_sort(F.collect_list(gone)).alias("missing"), *more)
    rate = F.round(F.coalesce(F.try_divide(100 * F.col("found"), F.col("total_fields")), F.lit(0.0)), 2)
    return out.withColumns({"match_rate": rate, "mean_confidence": F.round(F.coalesce("mean", F.lit(0.0)), 3)}).drop("mean")


def form_statistics(fields: DataFrame, matches: DataFrame) -> DataFrame:
    """Per document: fields that aren't blank, those found, rate in percent, mean confidence, names of the missing ones in order."""
    return _statistics(fields, matches)


def native_forms(matches: DataFrame, fields: DataFrame) -> DataFrame:
    """A row for each document with fields: ``form`` (id, label, text, box, page) by page and field, statistics, missing fields. One join."""
    box = F.array(*(F.col("bbox")[s] for s in g.SIDES))
    item = F.struct("page_num", "field_ord", F.col("field_name").alias("label"), F.col("matched_text").alias("text"), box.alias("box"))
    form = F.array_sort(F.collect_list(F.when(F.col("confidence").isNotNull(), item))).alias("form")
    one = lambda x, i: F.struct(i.alias("id"), x["label"].alias("label"), x["text"].alias("text"), x["box"].alias("box"), x["page_num"].alias("page"))
    return _statistics(fields, matches, form).withColumn("form", F.transform("form", one))


def linked_forms(items: DataFrame) -> DataFrame:
    """A row for each document from items with boxes: ``form`` with words and links, and counts of items, labels and words."""
    rows = split_words(items)
    item = F.struct("id", F.col("kind").alias("label"), "text", F.array(*(F.col("box")[s] for s in g.SIDES)).alias("box"), "words", "linking", F.col("page_num").alias("page"))
    form = rows.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("id", item.alias("item")))).alias("form"))
    form = form.withColumn("form", F.transform("form", lambda x: x["item"]))
    words = F.aggregate("form", F.lit(0), lambda n, x: n + F.size(x["words"]))
    return form.withColumns({"n_items": F.size("form"), "n_labels": F.size(F.filter("form", lambda x: x["label"] == "question")), "n_words": words})


def as_json(rows: DataFrame) -> DataFrame:
    """``doc_id, json``: everything else of a row as one text, to be written packed."""
    return rows.select("doc_id", F.to_json(F.struct(*(c for c in rows.columns if c != "doc_id"))).alias("json"))


def multipage_parts(rows: DataFrame, order: list[str], size: int = 192) -> DataFrame:
    """``part`` and ``chunk`` of rows of many-paged documents: page 0 is the header, in runs of ``size``; each page after it is one of items."""
    header = F.col("page_num") == 0
    out = chunks(rows, ["doc_id", "page_num"], order, size)
    return out.withColumn("part", F.when(header, "header").otherwise("items")).withColumn("chunk", F.when(header, F.col("chunk")).otherwise(0))


def pages_with_images(samples: DataFrame, images: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Samples joined to images by ``doc_id``, and the samples that have none."""
    return samples.join(images, "doc_id"), samples.join(images.select("doc_id"), "doc_id", "left_anti")


def hits_as_matches(hits: DataFrame) -> DataFrame:
    """Search hits (``text`` is what was looked for) as sure matches: multiline where the text has a line feed."""
    return hits.withColumns({"confidence": F.lit(1.0), "match_type": F.when(F.contains("text", F.lit("\n")), "multiline").otherwise("exact")})


def structure_preview(fields: DataFrame, k: int = 10, letters: int = 50) -> DataFrame:
    """The first ``k`` keys of each annotation, values cut to ``letters`` with three dots after."""
    v = F.col("field_value")
    cut = F.concat(F.substring(v, 1, letters), F.when(F.length(v) > letters, "...").otherwise(""))
    return fields.where(F.col("field_ord") < k).select("doc_id", "field_ord", "field_name", cut.alias("preview"))
