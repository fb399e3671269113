"""Settings as nested dictionaries: defaults filled in, names and choices checked, the input left as it is."""

from __future__ import annotations

import copy

from pyspark.sql import Column, DataFrame

from .functions import text
from .operators import match

#: Names, defaults and choices of the settings.
DEFAULTS: dict = {
    "normalizer": {"unicode_form": "NFKC", "lowercase": True, "remove_extra_whitespace": True, "remove_punctuation": False, "custom_replacements": {}},
    "matcher": {"strategy": "auto", "case_sensitive": False, "fuzzy_threshold": 80.0, "use_multiline": True, "max_matches_per_field": 1, "prefer_first_match": True},
    "exporter": {"format": "json", "output_dir": "output", "include_confidence": True, "include_metadata": True, "normalize_coords": False, "target_scale": 1000},
    "pdf_extractor": {"extract_images": False, "use_word_level": True, "search_case_sensitive": False, "use_quads_for_rotated": False},
    "flatten_json": True,
    "json_separator": ".",
    "ignore_json_keys": [],
    "verbose": False,
    "log_level": "INFO",
}
CHOICES = {
    ("matcher", "strategy"): ("exact", "fuzzy", "multiline", "auto"),
    ("exporter", "format"): ("layoutlm", "coco", "pascal_voc", "yolo", "json", "csv"),
}


def settings(given: dict | None = None) -> dict:
    """All settings: the given ones over the defaults. Unknown names in a section, and unknown choices, raise ValueError; other unknown names are left out."""
    out = copy.deepcopy(DEFAULTS)
    for name, value in copy.deepcopy(given or {}).items():
        if name not in out:
            continue
        if not isinstance(out[name], dict):
            out[name] = value
            continue
        if unknown := set(value) - set(out[name]):
            raise ValueError(f"unknown settings in {name}: {sorted(unknown)}")
        out[name] |= value
    for (section, name), allowed in CHOICES.items():
        if out[section][name] not in allowed:
            raise ValueError(f"{section}.{name} is {out[section][name]!r}, not one of {allowed}")
    return out


def normal_of(config: dict):
    """The normaliser that the settings ask for, as a function of a column."""
    own, sensitive = config["normalizer"], config["matcher"]["case_sensitive"]

    def normal(c: Column) -> Column:
        return text.match_text(c, lower=own["lowercase"] and not sensitive, drop_punctuation=own["remove_punctuation"], replacements=own["custom_replacements"], compose=own["unicode_form"] == "NFKC")

    return normal


def align(words: DataFrame, fields: DataFrame, config: dict) -> DataFrame:
    """One match of each field by the settings' strategy, threshold and treatment of line breaks."""
    own = config["matcher"]
    return match.routed(words, fields, own["strategy"], own["use_multiline"], own["fuzzy_threshold"], normal=normal_of(config))
