"""JSON annotations as field rows."""

from __future__ import annotations

import json
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flatten(value: dict, ignored: Iterable[str] = (), separator: str = ".") -> dict[str, str]:
    """Scalars of a nested object by path: ``a.b``, ``k[i]``, ``k[i].b``.

    Lists inside lists stay JSON text, empty objects and lists vanish, ignored
    keys are passed over at any depth, and a later path replaces an equal one.
    """
    skip, out = set(ignored), {}

    def text(x) -> str:
        return "" if x is None else x if isinstance(x, str) else json.dumps(x, ensure_ascii=False) if isinstance(x, list) else str(x)

    def walk(node: dict, at: str) -> None:
        for key, x in node.items():
            if key in skip:
                continue
            path = f"{at}{separator}{key}" if at else key
            if isinstance(x, dict):
                walk(x, path)
            elif isinstance(x, list):
                for i, item in enumerate(x):
                    if isinstance(item, dict):
                        walk(item, f"{path}[{i}]")
                    else:
                        out[f"{path}[{i}]"] = text(item)
            else:
                out[path] = text(x)

    walk(value, "")
    return out


def flat_fields(ignored: Iterable[str] = (), separator: str = "."):
    """An Arrow UDF from JSON text to an ordered array of (name, value); null for what is no JSON object."""
    skip = tuple(ignored)

    @F.pandas_udf("array<struct<field_name: string, field_value: string>>")
    def run(s: pd.Series) -> pd.Series:
        def one(raw):
            try:
                value = json.loads(raw)
            except (TypeError, ValueError):
                return None
            return [{"field_name": k, "field_value": v} for k, v in flatten(value, skip, separator).items()] if isinstance(value, dict) else None

        return s.map(one)

    return run


def fields(annotations: DataFrame, raw: str = "json", only: list[str] | None = None, **options) -> DataFrame:
    """``doc_id, field_ord, field_name, field_value`` of each annotation, in its order."""
    rows = annotations.select("doc_id", F.posexplode(flat_fields(**options)(F.col(raw))).alias("field_ord", "f")).select("doc_id", "field_ord", "f.field_name", "f.field_value")
    return rows.where(F.col("field_name").isin(only)) if only else rows


def field_array(names: list[str]) -> Column:
    """An array of ``field_ord, field_name, field_value`` out of columns, nulls as empty values."""
    return F.array(*(F.struct(F.lit(k).alias("field_ord"), F.lit(n).alias("field_name"), F.coalesce(F.col(n).cast("string"), F.lit("")).alias("field_value")) for k, n in enumerate(names)))


def fields_of_columns(rows: DataFrame, names: list[str]) -> DataFrame:
    """The same for annotations whose keys are columns: no UDF, nulls as empty values."""
    return rows.select("doc_id", F.explode(field_array(names)).alias("f")).select("doc_id", "f.field_ord", "f.field_name", "f.field_value")


def leaf_name(name: Column) -> Column:
    return F.substring_index(name, ".", -1)


def metadata(c: Column) -> list[Column]:
    """What a field's text looks like: ``n_chars, is_numeric, is_empty``."""
    return [F.length(c).alias("n_chars"), c.rlike(r"^[+-]?[0-9]+(\.[0-9]+)?$").alias("is_numeric"), (F.trim(c) == "").alias("is_empty")]


def searchable_values(fields: DataFrame) -> DataFrame:
    return fields.where(F.trim("field_value") != "").select("doc_id", "field_value").distinct()


def value_class(name: Column, c: Column) -> Column:
    """null, numeric, date (the name says so) or text."""
    return F.when(c.isNull(), "null").when(c.rlike(r"^[+-]?[0-9]+(\.[0-9]+)?$"), "numeric").when(F.lower(name).contains("fecha"), "date").otherwise("text")


#: Keys under which annotations keep line items; of several the last counts.
ITEM_KEYS = ("items", "productos", "detalles", "lineas")


def items(annotations: DataFrame, item_schema: str, raw: str = "json") -> DataFrame:
    """``doc_id, item_idx, item`` of the list under one of the item keys, parsed before anything is flattened."""
    lists = [F.from_json(F.get_json_object(raw, f"$.{k}"), f"array<{item_schema}>") for k in reversed(ITEM_KEYS)]
    return annotations.select("doc_id", F.posexplode(F.coalesce(*lists)).alias("item_idx", "item"))


def label_map(names: DataFrame) -> DataFrame:
    """``label, label_id``: O is 0, field names follow in order."""
    rows = names.select("field_name").distinct().agg(F.array_sort(F.collect_set("field_name")).alias("n"))
    return rows.select(F.posexplode(F.concat(F.array(F.lit("O")), "n")).alias("label_id", "label")).select("label", "label_id")


def bio_label_map(names: DataFrame) -> DataFrame:
    """``label, label_id``: O is 0, then B- and I- of each field name in order."""
    one = label_map(names).where("label <> 'O'")
    two = F.explode(F.array(F.struct(F.concat(F.lit("B-"), "label").alias("label"), (2 * F.col("label_id") - 1).alias("label_id")), F.struct(F.concat(F.lit("I-"), "label").alias("label"), (2 * F.col("label_id")).alias("label_id"))))
    return one.select(two.alias("x")).select("x.*").unionByName(names.sparkSession.createDataFrame([("O", 0)], "label string, label_id int"))
