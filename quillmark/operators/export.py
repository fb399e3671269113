"""Rows and files of the annotation formats.

Each format is a DataFrame first (``*_rows``); :func:`write` puts it out in
parallel, a row or a partition for each file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g


def categories(names: DataFrame) -> DataFrame:
    """``category_id, field_name``: distinct names in order, from 1. Their number is that of distinct fields."""
    n = names.select("field_name").distinct().agg(F.array_sort(F.collect_set("field_name")).alias("n"))
    return n.select(F.posexplode("n").alias("category_id", "field_name")).select((F.col("category_id") + 1).alias("category_id"), "field_name")


def coco_images(matches: DataFrame) -> DataFrame:
    size = matches.groupBy("doc_id", "page_num").agg(F.first("page_width").alias("w"), F.first("page_height").alias("h"))
    return size.select("doc_id", (F.col("page_num") + 1).alias("image_id"), F.format_string("%d_page_%d.png", "doc_id", "page_num").alias("file_name"), F.col("w").cast("int").alias("width"), F.col("h").cast("int").alias("height"))


def coco_rows(matches: DataFrame) -> DataFrame:
    """Annotations with ids from 1 in each document, boxes as x, y, width, height, and corners of the polygon."""
    b = F.col("bbox")
    order = Window.partitionBy("doc_id").orderBy("field_ord", "page_num", "start_idx")
    rows = matches.join(categories(matches), "field_name")
    return rows.select(
        "doc_id", F.row_number().over(order).alias("id"), (F.col("page_num") + 1).alias("image_id"), "category_id",
        g.as_xywh(b).alias("bbox"), g.area(b).alias("area"), F.lit(0).alias("iscrowd"), "text", "confidence", "match_type",
        F.array(b["x0"], b["y0"], b["x1"], b["y0"], b["x1"], b["y1"], b["x0"], b["y1"]).alias("segmentation"),
    )


def yolo_rows(matches: DataFrame, classes: list[str] | None = None) -> DataFrame:
    """Lines ``class cx cy w h`` by page, from 0; names that aren't among the given classes are class 0."""
    b, w, h = F.col("bbox"), F.col("page_width"), F.col("page_height")
    if classes is None:
        rows = matches.join(categories(matches), "field_name").withColumn("cls", F.col("category_id") - 1)
    else:
        rows = matches.withColumn("cls", F.greatest(F.array_position(F.lit(classes), F.col("field_name")).cast("int") - 1, F.lit(0)))
    line = F.format_string("%d %.6f %.6f %.6f %.6f", F.col("cls"), g.center_x(b) / w, g.center_y(b) / h, g.width(b) / w, g.height(b) / h)
    return rows.select("doc_id", "page_num", "field_ord", line.alias("line"))


def _escaped(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def voc_rows(matches: DataFrame) -> DataFrame:
    """One XML document for each page, coordinates truncated."""
    n = lambda s: F.col("bbox")[s].cast("int").cast("string")
    obj = F.concat(F.lit("<object><name>"), _escaped(F.col("field_name")), F.lit("</name><bndbox><xmin>"), n("x0"), F.lit("</xmin><ymin>"), n("y0"), F.lit("</ymin><xmax>"), n("x1"), F.lit("</xmax><ymax>"), n("y1"), F.lit("</ymax></bndbox></object>"))
    page = matches.withColumn("o", obj).groupBy("doc_id", "page_num").agg(F.array_sort(F.collect_list(F.struct("field_ord", "o"))).alias("all"), F.first("page_width").alias("w"), F.first("page_height").alias("h"))
    xml = F.concat(
        F.lit("<annotation><filename>"), F.format_string("%d_page_%d.png", "doc_id", "page_num"), F.lit("</filename><size><width>"), F.col("w").cast("int").cast("string"), F.lit("</width><height>"),
        F.col("h").cast("int").cast("string"), F.lit("</height><depth>3</depth></size>"), F.array_join(F.transform("all", lambda x: x["o"]), ""), F.lit("</annotation>"),
    )
    return page.select("doc_id", "page_num", xml.alias("xml"))


def csv_rows(matches: DataFrame) -> DataFrame:
    return matches.select("doc_id", "field_ord", "field_name", "text", *(F.col("bbox")[s].alias(s) for s in g.SIDES), F.col("page_num").alias("page"), "confidence", "match_type", "page_width", "page_height")


def json_rows(matches: DataFrame) -> DataFrame:
    """One JSON text for each document: number of fields and annotations in field order."""
    one = F.struct("field_ord", F.struct("field_name", "text", "bbox", F.col("page_num").alias("page"), "confidence", "match_type").alias("a"))
    rows = matches.groupBy("doc_id").agg(F.array_sort(F.collect_list(one)).alias("all"))
    return rows.select("doc_id", F.to_json(F.struct(F.lit("custom").alias("format"), F.size("all").alias("total_fields"), F.transform("all", lambda x: x["a"]).alias("annotations"))).alias("json"))


def color(name: Column) -> Column:
    """A colour that depends on the name alone."""
    return F.format_string("#%06x", F.pmod(F.xxhash64(name), F.lit(16777216)))


def layout_pages(matches: DataFrame) -> DataFrame:
    """Per page: field names, texts and 0..1000 boxes in field order."""
    n = g.layout_box(F.col("bbox"), F.col("page_width"), F.col("page_height"))
    rows = matches.withColumn("n", n).groupBy("doc_id", "page_num").agg(F.array_sort(F.collect_list(F.struct("field_ord", "field_name", "matched_text", "n"))).alias("all"))
    return rows.select("doc_id", "page_num", F.transform("all", lambda x: x["field_name"]).alias("names"), F.transform("all", lambda x: x["matched_text"]).alias("texts"), F.transform("all", lambda x: F.array(*(x["n"][s] for s in g.SIDES))).alias("boxes"))


def picture_rows(matches: DataFrame) -> DataFrame:
    """Per page its size and the fields to draw, in field order, each with a colour by its name."""
    one = F.struct("field_ord", F.struct(F.col("field_name").alias("name"), F.col("matched_text").alias("text"), F.array(*(F.col("bbox")[s] for s in g.SIDES)).alias("bbox"), "confidence", "match_type", color(F.col("field_name")).alias("color")).alias("f"))
    rows = matches.groupBy("doc_id", "page_num").agg(F.first("page_width").alias("width"), F.first("page_height").alias("height"), F.array_sort(F.collect_list(one)).alias("all"))
    return rows.select("doc_id", "page_num", "width", "height", F.transform("all", lambda x: x["f"]).alias("fields"))


def as_format(matches: DataFrame, fmt: str) -> DataFrame:
    """The rows of an export format: json, csv, layoutlm, coco (annotations), yolo, pascal_voc."""
    formats = {"json": json_rows, "csv": csv_rows, "layoutlm": layout_pages, "coco": coco_rows, "yolo": yolo_rows, "pascal_voc": voc_rows}
    if fmt not in formats:
        raise ValueError(f"no export format {fmt!r}, only {sorted(formats)}")
    return formats[fmt](matches)


def write(rows: DataFrame, path: str, fmt: str) -> None:
    """Writes the rows of a format: ``csv`` with a header, ``json``, ``parquet``; ``yolo`` and ``voc`` by document and page as text."""
    if fmt == "csv":
        rows.write.csv(path, header=True)
    elif fmt == "yolo":
        rows.select("doc_id", "page_num", F.col("line").alias("value")).write.partitionBy("doc_id", "page_num").text(path)
    elif fmt == "voc":
        rows.select("doc_id", "page_num", F.col("xml").alias("value")).write.partitionBy("doc_id", "page_num").text(path)
    elif fmt == "json":
        rows.write.json(path)
    else:
        rows.write.parquet(path)
