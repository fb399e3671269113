"""Text normalisation and tokenising as Column expressions.

Unicode decomposition has no Spark built-in; the two functions that need it are
Arrow UDFs, and :func:`normalize` calls one only where a text isn't ASCII.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

SPACES = r"(?U)\s+"


@F.pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Unicode compatibility composition."""
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


@F.pandas_udf(StringType())
def strip_accents(s: pd.Series) -> pd.Series:
    """Canonical decomposition without the combining marks."""
    return s.map(lambda x: None if x is None else "".join(c for c in unicodedata.normalize("NFD", x) if unicodedata.category(c) != "Mn"))


@F.pandas_udf(StringType())
def ascii_fold(s: pd.Series) -> pd.Series:
    """Compatibility decomposition without anything beyond ASCII."""
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode())


def composed(c: Column) -> Column:
    """NFKC of a text; ASCII texts are left in the JVM."""
    beyond = F.length(c) != F.octet_length(c)
    return F.coalesce(nfkc(F.when(beyond, c)), c)  # a UDF gets every row, so others are sent as nulls


def collapse(c: Column) -> Column:
    """Runs of Unicode white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(c, SPACES, " "))


def normalize(c: Column, lower: bool = True, drop_punctuation: bool = False, replacements: dict[str, str] | None = None, compose: bool = True) -> Column:
    """Composition, ordered replacements, lower case, punctuation, white space."""
    c = composed(c) if compose else c
    for old, new in (replacements or {}).items():
        c = F.replace(c, F.lit(old), F.lit(new))
    c = F.lower(c) if lower else c
    if drop_punctuation:
        c = F.regexp_replace(c, r"(?U)[^\w\s]", "")
    return collapse(c)


#: Options of :func:`normalize` by name.
PRESETS: dict[str, dict[str, bool]] = {"default": {}, "strict": {}, "fuzzy": {"drop_punctuation": True}}


#: Zero-width characters that matching ignores; curly quotes with their straight forms.
ZERO_WIDTH = "​‌‍﻿"
QUOTES = ("‘’“”", "''\"\"")


def match_text(c: Column, straight_quotes: bool = False, **options) -> Column:
    """What is compared: the normalised text without zero-width characters."""
    c = F.translate(normalize(c, **options), ZERO_WIDTH, "")
    if straight_quotes:
        c = F.translate(c, *QUOTES)
    return collapse(c)


#: What the expressions here take for white space.
_WHITE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_NO_WIDTH = {ord(c): None for c in ZERO_WIDTH}


def plain_words(s: str) -> list[str]:
    """Words of a text that aren't empty."""
    return [x for x in _WHITE.split(s) if x]


def plain_match_text(s: str) -> str:
    """:func:`match_text` of a plain text."""
    if s.isascii():
        return " ".join(plain_words(s.lower()))
    s = " ".join(plain_words(unicodedata.normalize("NFKC", s).lower()))
    return " ".join(plain_words(s.translate(_NO_WIDTH)))


class Normals(dict):
    """Texts with what :func:`plain_match_text` (or another function) makes of them, which is remembered."""

    def __init__(self, normal=plain_match_text):
        super().__init__()
        self._normal = normal

    def __missing__(self, s: str) -> str:
        out = self[s] = self._normal(s)
        return out

    def trim(self, most: int = 1 << 18) -> None:
        """Forgets all if there are more than ``most``."""
        if len(self) > most:
            self.clear()


def alphanumeric(c: Column) -> Column:
    return F.regexp_replace(c, r"[^a-zA-Z0-9\s]", "")


def tokens(c: Column) -> Column:
    """Words of the normalised text."""
    return F.filter(F.split(c, r"(?U)\s+"), lambda x: x != "")


def digit_share(c: Column) -> Column:
    """Share of characters that are decimal digits or superscripts; 0 for an empty text."""
    return _share(c, r"[^\p{Nd}²³¹⁰-⁹₀-₉]")


def letter_share(c: Column) -> Column:
    return _share(c, r"[^\p{L}]")


def _share(c: Column, other: str) -> Column:
    return F.when(F.length(c) > 0, F.length(F.regexp_replace(c, other, "")) / F.length(c)).otherwise(F.lit(0.0))


def mostly_numeric(c: Column) -> Column:
    return digit_share(c) > 0.5


def mostly_alphabetic(c: Column) -> Column:
    return letter_share(c) > 0.5


def weighted_text(c: Column, aggressive: bool = False, fold: bool = True) -> Column:
    """Normalisation of the weighted matcher: ASCII, lower case, without commas and dots (or any punctuation)."""
    c = F.lower(ascii_fold(c)) if fold else F.lower(c)
    c = collapse(F.coalesce(c, F.lit("")))
    if aggressive:
        c = F.regexp_replace(c, r"_|[^\w\s]", " ")
        return collapse(c)
    return F.trim(F.translate(c, ",.", ""))


def number_text(c: Column) -> Column:
    """Without thousands separators and spaces. Commas go first, so a decimal comma is lost (kept for parity)."""
    return F.translate(c, ", ", "")


def tax_id(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\D", "")


def date_text(c: Column) -> Column:
    return F.translate(c, "/-.", "")


#: Parts of field names that tell a field's type, in the order they are tried.
FIELD_TYPES = {
    "ruc": ("ruc", "nit", "tax", "cuit", "dni"),
    "date": ("fecha", "date", "vencimiento"),
    "number": ("total", "subtotal", "precio", "monto", "amount", "igv", "iva"),
}


def field_type(name: Column) -> Column:
    """ruc, date, number or text, by the first part found in the name."""
    out = None
    for kind, parts in FIELD_TYPES.items():
        test = F.lower(name).rlike("|".join(parts))
        out = F.when(test, kind) if out is None else out.when(test, kind)
    return out.otherwise("text")


def by_field_type(c: Column, kind: Column, fold: bool = True) -> Column:
    """The normalisation that a field's type calls for."""
    return F.when(kind == "ruc", tax_id(c)).when(kind == "date", date_text(c)).when(kind == "number", weighted_text(number_text(c), fold=fold)).otherwise(weighted_text(c, fold=fold))


def search_variants(c: Column) -> Column:
    """The text as it is, with line breaks as spaces, and with single spaces; each once."""
    return F.array_distinct(F.array(c, F.regexp_replace(c, r"[\r\n]", " "), collapse(c)))


def lines(c: Column) -> Column:
    """Lines that aren't blank, without space at their ends."""
    return F.filter(F.transform(F.split(c, "\n"), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", "")), lambda x: x != "")


#: Labels that stand beside the values of fields; the first map is for forms, the second for tables.
LABELS = {
    "ruc": ["ruc", r"r\.?u\.?c\.?", "registro", "tax", "id"],
    "nombre": ["nombre", "razon", "social", "name", "company"],
    "total": ["total", "importe", "monto", "amount", "sum"],
    "subtotal": ["subtotal", "base", "imponible"],
    "igv": ["igv", r"i\.?g\.?v\.?", "iva", "tax", "impuesto"],
    "fecha": ["fecha", "date", "emision", "emission"],
    "numero": ["numero", r"n°", "num", "number", "factura", "invoice"],
}
FORM_LABELS = LABELS | {
    "direccion": ["direccion", "domicilio", "address", "ubicacion"],
    "telefono": ["telefono", "tel", "phone", "celular"],
    "email": ["email", "correo", "mail"],
    "moneda": ["moneda", "currency"],
}
TABLE_LABELS = LABELS | {
    "cantidad": ["cantidad", "cant", "qty", "quantity"],
    "precio": ["precio", "price", "unit", "unitario"],
    "descripcion": ["descripcion", "description", "detalle", "item"],
}


def label_pattern(name: str, labels: dict[str, list[str]] = FORM_LABELS) -> str:
    """One case-insensitive alternation of the labels of a field name; driver-side, for each distinct name."""
    own = [w for w in re.split(r"[_\-\s]+", name.lower()) if w]
    found = [rf"\b{re.escape(w)}\b" for w in own] + [x for w in own for key, more in labels.items() if key in w or w in key for x in more]
    return "(?iu)" + "|".join(dict.fromkeys(found)) if found else r"(?!)"


def word_boxes(text: Column, x0: Column, x1: Column) -> Column:
    """Words of a text with first and last x of boxes that share its width by their letters: array of (word, x0, x1).

    The gap is 2 % of the width, 5 at least. One word has the whole width.
    """
    words = tokens(text)
    n, width = F.size(words), x1 - x0
    gap = F.greatest(F.lit(5.0), width * 0.02)
    letters = F.length(F.array_join(words, ""))
    free = width - (n - 1) * gap
    before = lambda i: F.length(F.array_join(F.slice(words, F.lit(1), i), ""))
    start = lambda i: x0 + free * before(i) / letters + i * gap
    many = F.transform(words, lambda w, i: F.struct(w.alias("word"), start(i).cast("int").alias("x0"), (start(i) + free * F.length(w) / letters).cast("int").alias("x1")))
    one = F.transform(words, lambda w: F.struct(w.alias("word"), x0.cast("int").alias("x0"), x1.cast("int").alias("x1")))
    return F.when(n > 1, many).otherwise(one)
