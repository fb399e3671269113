"""Statistics and validation of matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Limits of the validation rules.
MIN_CONFIDENCE, MIN_AREA, MAX_ERROR_RATE = 0.70, 10, 0.05


def document_stats(fields: DataFrame, matches: DataFrame) -> DataFrame:
    """Per document: fields (blank ones too), matched, unmatched, rate in percent, mean confidence, pages."""
    n = fields.groupBy("doc_id").agg(F.count("*").alias("total"))
    m = matches.groupBy("doc_id").agg(F.count("*").alias("matched"), F.avg("confidence").alias("mean_confidence"), F.array_sort(F.collect_set("page_num")).alias("pages"))
    out = n.join(m, "doc_id", "left").withColumn("matched", F.coalesce("matched", F.lit(0)))
    return out.withColumns({"unmatched": F.col("total") - F.col("matched"), "match_rate": 100 * F.col("matched") / F.col("total"), "pages": F.coalesce("pages", F.array().cast("array<int>"))})


def type_histogram(matches: DataFrame, by: list[str]) -> DataFrame:
    return matches.groupBy(*by, "match_type").agg(F.count("*").alias("n"))


def type_maps(matches: DataFrame) -> DataFrame:
    """The histogram of each document as one map."""
    rows = type_histogram(matches, ["doc_id"])
    return rows.groupBy("doc_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("match_type", "n")))).alias("types"))


def rollup(stats: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Over documents: sums, and the mean of the documents' rates and confidences (not weighted by fields)."""
    return stats.groupBy(*(by or [])).agg(F.count("*").alias("documents"), F.sum("total").alias("total"), F.sum("matched").alias("matched"), F.avg("match_rate").alias("mean_rate"), F.avg("mean_confidence").alias("mean_confidence"), F.min("match_rate").alias("min_rate"), F.max("match_rate").alias("max_rate"))


def page_distribution(matches: DataFrame) -> DataFrame:
    """Per page number: fields, documents, mean, least and most a document, share of all fields in percent."""
    own = matches.groupBy("doc_id", "page_num").agg(F.count("*").alias("n"))
    page = own.groupBy("page_num").agg(F.sum("n").alias("fields"), F.count("*").alias("documents"), F.avg("n").alias("mean_fields"), F.min("n").alias("min_fields"), F.max("n").alias("max_fields"))
    everywhere = Window.partitionBy(F.lit(0))  # a row for each page number
    return page.withColumn("share", 100 * F.col("fields") / F.sum("fields").over(everywhere))


def confidence_bands(matches: DataFrame, by: list[str] | None = None) -> DataFrame:
    c = F.col("confidence")
    return matches.groupBy(*(by or [])).agg(F.count_if(c >= 0.95).alias("high"), F.count_if((c >= 0.8) & (c < 0.95)).alias("medium"), F.count_if(c < 0.8).alias("low"))


def histogram(rows: DataFrame, value: Column, low: float, high: float, bins: int = 20) -> DataFrame:
    at = F.least(F.floor((value - low) / (high - low) * bins), F.lit(bins - 1)).cast("int")
    return rows.where((value >= low) & (value <= high)).groupBy(at.alias("bin")).agg(F.count("*").alias("n"))


def best_strategy(stats: DataFrame, rate: str = "match_rate", confidence: str = "mean_confidence") -> DataFrame:
    """The strategy with the best rate, then confidence; the first (least ``ord``) among equals."""
    return stats.agg(F.max_by("strategy", F.struct(F.col(rate), F.col(confidence), -F.col("ord"))).alias("strategy"))


def issues(items: DataFrame, min_confidence: float = MIN_CONFIDENCE, min_area: float = MIN_AREA) -> DataFrame:
    """One row for each broken rule: ``doc_id, field_ord, kind, severity``.

    ``items``: doc_id, field_ord, box (array), text, confidence, page_num. One
    pass, without a shuffle: rules give an array that is exploded.
    """
    b = [F.element_at("box", k) for k in (1, 2, 3, 4)]
    four = F.coalesce(F.size("box") == 4, F.lit(False))
    unit = F.forall("box", lambda c: (c >= 0) & (c <= 1))
    inside = (b[0] >= 0) & (b[1] >= 0) & (b[2] <= 1000) & (b[3] <= 1000) & (b[0] < b[2]) & (b[1] < b[3])
    w, h = b[2] - b[0], b[3] - b[1]
    aspect = w / F.when(h > 0, h)
    rule = lambda test, kind, severity: F.when(test, F.struct(F.lit(kind).alias("kind"), F.lit(severity).alias("severity")))
    page = F.col("page_num")
    found = F.array_compact(
        F.array(
            rule(~four, "box_size", "error"),
            F.when(four, rule(unit, "box_unit_scale", "error")),
            F.when(four & ~unit, rule(~inside, "box_range", "error")),
            F.when(four, rule(w * h < min_area, "box_area", "warning")),
            F.when(four, rule((aspect > 50) | (aspect < 0.02), "box_aspect", "warning")),
            rule(F.coalesce(F.trim("text"), F.lit("")) == "", "text_empty", "error"),
            rule(F.col("confidence").isNull(), "confidence_type", "warning"),
            rule(F.col("confidence") < min_confidence, "confidence_low", "warning"),
            rule(page.isNull(), "page_missing", "warning"),
            rule(page < 0, "page_invalid", "error"),
        )
    )
    return items.select("doc_id", "field_ord", F.explode(found).alias("i")).select("doc_id", "field_ord", "i.kind", "i.severity")


def validation_summary(items: DataFrame, found: DataFrame) -> DataFrame:
    """One row over all documents: counts, rates, documents with an error or over 5 warnings, and fitness for training."""
    n = items.groupBy("doc_id").agg(F.count("*").alias("n"))
    i = found.groupBy("doc_id").agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"))
    per = n.join(i, "doc_id", "left").fillna(0)
    out = per.agg(F.count("*").alias("documents"), F.sum("n").alias("fields"), F.sum("errors").alias("errors"), F.sum("warnings").alias("warnings"), F.count_if((F.col("errors") > 0) | (F.col("warnings") > 5)).alias("problem_documents"))
    rate = F.try_divide(F.col("errors"), F.col("fields"))
    return out.withColumns({"error_rate": rate, "fit_for_training": F.coalesce((rate <= MAX_ERROR_RATE) & (F.col("fields") > 0) & (F.col("problem_documents") < F.col("documents")), F.lit(False))})


def page_checks(matches: DataFrame, pages: DataFrame, stats: DataFrame) -> DataFrame:
    """Per document: pages without a field, pages out of range, boxes off the page, band of the match rate, and the state.

    ``pages``: doc_id, n_pages, page_width, page_height.
    """
    m = matches.join(pages, "doc_id")
    off = (F.col("bbox.x0") < 0) | (F.col("bbox.y0") < 0) | (F.col("bbox.x1") > F.col("page_width")) | (F.col("bbox.y1") > F.col("page_height"))
    valid = (F.col("page_num") >= 0) & (F.col("page_num") < F.col("n_pages"))
    m = m.groupBy("doc_id").agg(F.count_distinct(F.when(valid, F.col("page_num"))).alias("used"), F.count_if(~valid).alias("out_of_range"), F.count_if(valid & off).alias("off_page"))
    out = pages.select("doc_id", "n_pages").join(m, "doc_id", "left").fillna(0).join(stats.select("doc_id", "match_rate"), "doc_id")
    out = out.withColumn("empty_pages", F.col("n_pages") - F.col("used"))
    error = (F.col("out_of_range") > 0) | (F.col("match_rate") < 70)
    warning = (F.col("empty_pages") > 0) | (F.col("off_page") > 0) | (F.col("match_rate") < 80)
    return out.select("doc_id", "empty_pages", "out_of_range", "off_page", "match_rate", F.when(error, "ERROR").when(warning, "WARNING").otherwise("SUCCESS").alias("state"))
