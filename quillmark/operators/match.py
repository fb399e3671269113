"""Matching of field values to windows of words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import similarity, text


def runs(words: DataFrame, max_size: int, normal: Column | None = None, skip_empty: bool = False) -> DataFrame:
    """Each word with the ``run`` of it and the next ``max_size`` - 1 words of its page: array of (word_idx, text, norm, bbox).

    Each page is sorted once and read by offsets; a page is the unit of work,
    and no document is gathered whole.
    """
    w = words.withColumn("norm", normal if normal is not None else F.col("text"))
    if skip_empty:
        w = w.where("norm <> ''")
    order = Window.partitionBy("doc_id", "page_num").orderBy("word_idx")
    one = F.struct("word_idx", "text", "norm", "bbox")
    ahead = F.array_compact(F.array(one, *(F.lead(one, k).over(order) for k in range(1, max_size))))
    return w.select("doc_id", "page_num", "page_width", "page_height", "norm", F.col("word_idx").alias("start_idx"), ahead.alias("run"))


def _of_run(run: Column) -> list[Column]:
    """``matched text, box, last index`` of a run."""
    side = lambda f, s: f(F.transform(run, lambda x: x["bbox"][s]))
    b = g.box(side(F.array_min, "x0"), side(F.array_min, "y0"), side(F.array_max, "x1"), side(F.array_max, "y1"))
    return [F.array_join(F.transform(run, lambda x: x["text"]), " "), b, F.element_at(run, -1)["word_idx"]]


def windows(words: DataFrame, max_size: int, normal: Column | None = None, skip_empty: bool = False) -> DataFrame:
    """Runs of 1 to ``max_size`` words of a page: ``doc_id, page_num, start_idx, end_idx, size, text, bbox``.

    With ``skip_empty`` words that normalise to nothing don't count.
    """
    rows = runs(words, max_size, normal, skip_empty)
    rows = rows.withColumn("size", F.explode(F.sequence(F.lit(1), F.size("run")))).withColumn("run", F.slice("run", F.lit(1), F.col("size")))
    joined, b, last = _of_run(F.col("run"))
    return rows.select("doc_id", "page_num", "page_width", "page_height", "start_idx", "size", joined.alias("text"), b.alias("bbox"), last.alias("end_idx"))


def windows_of_sizes(words: DataFrame, sizes: DataFrame) -> DataFrame:
    """Runs of words of a page of the sizes that ``doc_id, sizes`` asks for, as in :func:`windows`.

    Words are shuffled once, by document, and gathered by page; what is joined
    by document afterwards finds them in place.
    """
    one = F.struct("word_idx", "text", "bbox")
    pages = words.repartition("doc_id").groupBy("doc_id", "page_num").agg(F.array_sort(F.collect_list(one)).alias("ws"), F.first("page_width").alias("page_width"), F.first("page_height").alias("page_height"))
    n = F.size("ws")

    def window(size: Column, at: Column) -> Column:
        run = F.slice("ws", at, size)
        joined, b, last = _of_run(run)
        return F.struct(run[0]["word_idx"].alias("start_idx"), size.alias("size"), joined.alias("text"), b.alias("bbox"), last.alias("end_idx"))

    of_size = lambda size: F.transform(F.sequence(F.lit(1), n - size + 1), lambda at: window(size, at))
    rows = pages.join(sizes, "doc_id").withColumn("w", F.explode(F.flatten(F.transform(F.filter("sizes", lambda x: x <= n), of_size))))
    return rows.select("doc_id", "page_num", "page_width", "page_height", "w.*")


def with_tokens(fields: DataFrame, normal=text.match_text) -> DataFrame:
    """Fields that aren't blank, with the normalised words of their values."""
    rows = fields.where(F.trim("field_value") != "").withColumn("tokens", text.tokens(normal(F.col("field_value"))))
    return rows.where(F.size("tokens") > 0)


def exact(words: DataFrame, fields: DataFrame, normal=text.match_text, contiguous: bool = False) -> DataFrame:
    """All windows whose normalised words equal a field's, of any length, in arrays, so words with spaces inside never match.

    Words are joined to single tokens of their document's values, and a match
    is a run of as many hits as the value has tokens that begin at one place, so
    only hits are gathered. ``contiguous`` says that ``word_idx`` counts a
    page's words without gaps; otherwise words are numbered here, which sorts
    each page. Fields that repeat key and value count once.
    """
    f = with_tokens(fields, normal)
    t = f.select("doc_id", "field_ord", "field_name", F.col("field_value").alias("value"), F.size("tokens").alias("n"), F.posexplode("tokens").alias("k", "norm"))
    w = words.select("doc_id", "page_num", "page_width", "page_height", "word_idx", "text", "bbox", normal(F.col("text")).alias("norm"))
    of_page = Window.partitionBy("doc_id", "page_num").orderBy("word_idx")
    if contiguous:  # words that normalise to nothing don't count: they are looked for like tokens
        wanted = t.select("doc_id", "norm").unionByName(t.select("doc_id", F.lit("").alias("norm"))).distinct()
        w = w.join(wanted, ["doc_id", "norm"], "left_semi")
        w = w.withColumn("at", F.col("word_idx") - F.sum((F.col("norm") == "").cast("int")).over(of_page))
    else:
        w = w.where("norm <> ''").withColumn("at", F.row_number().over(of_page))
    hit = w.join(t, ["doc_id", "norm"]).withColumn("at", F.col("at") - F.col("k"))
    one = F.struct("k", "word_idx", "text", "bbox")
    hit = hit.groupBy("doc_id", "field_ord", "field_name", "value", "n", "page_num", "page_width", "page_height", "at").agg(F.array_sort(F.collect_set(one)).alias("own")).where(F.size("own") == F.col("n"))
    joined, b, last = _of_run(F.col("own"))
    return hit.select("doc_id", "field_ord", "field_name", F.col("value").alias("text"), joined.alias("matched_text"), b.alias("bbox"), "page_num", "page_width", "page_height", F.col("own")[0]["word_idx"].alias("start_idx"), last.alias("end_idx"), F.col("n").alias("word_count"), F.lit(1.0).alias("confidence"), F.lit("exact").alias("match_type"))


_KEY = ["doc_id", "field_ord", "field_name"]


def first_match(matches: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """The best row of each field: by confidence, then smaller windows, then earlier ones."""
    by = Window.partitionBy(*_KEY).orderBy(*(order or [F.desc("confidence"), "word_count", "start_idx"]))
    return matches.withColumn("rank", F.row_number().over(by)).where("rank = 1").drop("rank")


def top_matches(matches: DataFrame, k: int = 10) -> DataFrame:
    by = Window.partitionBy(*_KEY).orderBy(F.desc("confidence"), "word_count", "start_idx")
    return matches.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def _greedy(matches: DataFrame, by: list[str], *more: str) -> DataFrame:
    """``kept``: of each group's matches, from the left, those that start after the end of the last one kept."""
    rows = matches.groupBy(*by).agg(F.array_sort(F.collect_set(F.struct("start_idx", "end_idx", *more))).alias("all"))
    kind = rows.schema["all"].dataType.simpleString()
    none = F.struct(F.array().cast(kind).alias("kept"), F.lit(-1).alias("end"))
    take = lambda acc, x: F.when(x["start_idx"] > acc["end"], F.struct(F.concat(acc["kept"], F.array(x)).alias("kept"), x["end_idx"].alias("end"))).otherwise(acc)
    return rows.select(*by, F.aggregate("all", none, take, lambda acc: acc["kept"]).alias("kept"))


def non_overlapping(matches: DataFrame) -> DataFrame:
    """Greedy from the left: a match is kept if it starts after the end of the last one kept. One row each: ``starts``."""
    return _greedy(matches, _KEY).select(*_KEY, F.col("kept.start_idx").alias("starts"))


def without_overlaps(matches: DataFrame) -> DataFrame:
    """Rows of matches that :func:`non_overlapping` keeps, each value of a field by itself."""
    by = [*_KEY, "text"]
    more = [c for c in matches.columns if c not in (*by, "start_idx", "end_idx")]
    return _greedy(matches, by, *more).select(*by, F.explode("kept").alias("m")).select(*by, "m.*").select(matches.columns)


def size_range(n: Column) -> tuple[Column, Column]:
    """Window sizes tried for a value of n words: half to one and a half times, in whole words."""
    return F.greatest(F.lit(1), F.floor(n * 0.5).cast("int")), F.floor(n * 1.5).cast("int")


def candidates(words: DataFrame, fields: DataFrame, own: Column, variants: dict[str, Column], more: dict[str, Column] | None = None) -> DataFrame:
    """Fields joined to the windows of their document whose sizes are in range, from the values' own lengths.

    ``own`` is the text of a value that is compared (``a``) and ``variants``
    are columns made of windows; both are made before the join, once a window
    and not once a pair. ``more`` adds columns of fields.
    """
    n = F.size(F.filter(F.split("field_value", r"(?U)\s+"), lambda x: x != ""))
    low, high = size_range(n)
    f = fields.where(F.trim("field_value") != "").select("doc_id", "field_ord", "field_name", "field_value", own.alias("a"), low.alias("low"), high.alias("high"), *(c.alias(k) for k, c in (more or {}).items()))
    f = f.withColumn("a_letters", similarity.letters(F.col("a")))
    sizes = f.groupBy("doc_id").agg(F.flatten(F.collect_set(F.sequence("low", "high"))).alias("sizes")).select("doc_id", F.array_distinct("sizes").alias("sizes"))
    win = windows_of_sizes(words, sizes).withColumns(variants)
    hit = f.join(win, (f["doc_id"] == win["doc_id"]) & (win["size"] >= f["low"]) & (win["size"] <= f["high"]))
    return hit.select(f["doc_id"], "field_ord", "field_name", f["field_value"].alias("text"), win["text"].alias("matched_text"), "bbox", "page_num", "page_width", "page_height", "start_idx", "end_idx", F.col("size").alias("word_count"), "a", "a_letters", *variants, *(more or {}))


def _pairs(words: DataFrame, fields: DataFrame, normal) -> DataFrame:
    b = normal(F.col("text"))
    return candidates(words, fields, normal(F.col("field_value")), {"b": b, "b_letters": similarity.letters(b)})


_SIDES = ("a", "b", "a_letters", "b_letters")


def fuzzy(words: DataFrame, fields: DataFrame, least: float = 80.0, scorer="ratio", normal=text.match_text) -> DataFrame:
    """Windows whose similarity to a value reaches ``least``. What can't reach it by its letters and length isn't scored.

    ``scorer`` is a name or a function of two texts that gives 0 to 100; nothing is known of a function, so it scores every window.
    """
    pairs = _pairs(words, fields, normal)
    if not callable(scorer):
        pairs = pairs.where(similarity.may_reach(scorer, *map(F.col, _SIDES), least))
    scored = pairs.withColumn("score", similarity.score(scorer, F.col("a"), F.col("b"), least)).where(F.col("score") >= least)
    return scored.withColumn("confidence", F.col("score") / 100).withColumn("match_type", F.lit("fuzzy")).drop(*_SIDES, "score")


def all_matches(words: DataFrame, fields: DataFrame, least: float = 80.0, normal=text.match_text, contiguous: bool = False) -> DataFrame:
    """All exact matches of a field, or if there are none all its fuzzy ones, best first by ``rank``."""
    sure = exact(words, fields, normal, contiguous)
    rest = fields.join(sure.select(*_KEY).distinct(), _KEY, "left_anti")
    out = sure.unionByName(fuzzy(words, rest, least, normal=normal).select(sure.columns))
    by = Window.partitionBy(*_KEY).orderBy(F.desc("confidence"), "word_count", "start_idx")
    return out.withColumn("rank", F.row_number().over(by))


def fuzzy_any(words: DataFrame, fields: DataFrame, least: float = 80.0, k: int = 5, normal=text.match_text) -> DataFrame:
    """Union of four scorers' best ``k``; of rows with one box and page the first scorer's is kept. Windows are made and scored once."""
    pairs = _pairs(words, fields, normal)
    can = [similarity.may_reach(name, *map(F.col, _SIDES), least) for name in similarity.FOUR]
    pairs = pairs.withColumn("can", F.array(*can)).where(F.array_contains("can", True))
    scored = pairs.select("*", F.posexplode(similarity.scores(F.col("a"), F.col("b"), F.col("can"), least)).alias("strategy", "score")).where(F.col("score") >= least)
    scored = scored.withColumn("confidence", F.col("score") / 100).withColumn("match_type", F.lit("fuzzy")).drop(*_SIDES, "score", "can")
    of_one = Window.partitionBy(*_KEY, "strategy").orderBy(F.desc("confidence"), "word_count", "start_idx")
    best = scored.withColumn("rank", F.row_number().over(of_one)).where(F.col("rank") <= k)
    by = Window.partitionBy(*_KEY, "page_num", "bbox").orderBy("strategy", "rank")
    return best.withColumn("n", F.row_number().over(by)).where("n = 1").drop("n", "rank")


def auto(words: DataFrame, fields: DataFrame, least: float = 80.0, normal=text.match_text, contiguous: bool = False) -> DataFrame:
    """The exact match of a field, else its best fuzzy one; only fields without an exact match are scored."""
    sure = first_match(exact(words, fields, normal, contiguous))
    rest = fields.join(sure.select(*_KEY), _KEY, "left_anti")
    return sure.unionByName(first_match(fuzzy(words, rest, least, normal=normal)).select(sure.columns))


def weighted(words: DataFrame, fields: DataFrame, least: float = 80.0, keep_empty: bool = True) -> DataFrame:
    """The best window of each field by the typed comparison and four weighted scores.

    Equal normalised texts have confidence 1 and aren't scored. With
    ``keep_empty`` two texts that normalise to nothing are equal (for parity).
    Types: exact from 98, fuzzy from ``least``.
    """
    kind, t = text.field_type(F.col("field_name")), F.col("text")
    variants = {"b_text": text.weighted_text(t), "b_number": text.weighted_text(text.number_text(t)), "b_ruc": text.tax_id(t), "b_date": text.date_text(t)}
    pairs = candidates(words, fields, text.by_field_type(F.col("field_value"), kind), variants, {"kind": kind})
    pairs = pairs.withColumn("b", F.when(F.col("kind") == "ruc", F.col("b_ruc")).when(F.col("kind") == "date", F.col("b_date")).when(F.col("kind") == "number", F.col("b_number")).otherwise(F.col("b_text"))).drop(*variants)
    same = F.col("a") == F.col("b")
    if not keep_empty:
        same = same & (F.col("a") != "")
    equal = pairs.where(same).withColumn("score", F.lit(100.0))
    rest = pairs.where(~same & (F.col("a") != "") & (F.col("b") != "")).withColumn("b_letters", similarity.letters(F.col("b")))
    rest = rest.where(similarity.may_reach("weighted", *map(F.col, _SIDES), least)).drop("b_letters")
    rest = rest.withColumn("score", similarity.score("weighted", F.col("a"), F.col("b"), least)).where(F.col("score") >= least)
    both = equal.unionByName(rest).withColumn("confidence", F.col("score") / 100)
    both = both.withColumn("match_type", F.when(F.col("score") >= 98, "exact").otherwise("fuzzy"))
    return first_match(both.drop("a", "a_letters", "b", "score", "kind"))


def merge_adjacent(matches: DataFrame, dy: float = 5.0, dx: float = 10.0) -> DataFrame:
    """Joins matches of a field that continue the one before on the page: top within ``dy`` of its bottom, left within ``dx`` of its right.

    Gaps and islands over (page, y0, x0); a group has the box around it, its
    texts in order and the mean confidence.
    """
    order = Window.partitionBy(*_KEY).orderBy("page_num", "bbox.y0", "bbox.x0", "start_idx")
    before = F.lag(F.struct("page_num", "bbox")).over(order)
    goes_on = (before["page_num"] == F.col("page_num")) & (F.abs(F.col("bbox.y0") - before["bbox"]["y1"]) <= dy) & (F.col("bbox.x0") - before["bbox"]["x1"] <= dx)
    rows = matches.withColumn("new", F.when(goes_on, 0).otherwise(1)).withColumn("at", F.row_number().over(order))
    rows = rows.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    own = F.transform(F.array_sort(F.collect_list(F.struct("at", "matched_text"))), lambda x: x["matched_text"])
    out = rows.groupBy(*_KEY, "page_num", "island").agg(F.array_join(own, " ").alias("matched_text"), g.merged(F.col("bbox")).alias("bbox"), F.avg("confidence").alias("confidence"), F.count("*").alias("n_merged"))
    return out.withColumn("match_type", F.when(F.col("n_merged") > 1, "merged_multiline").otherwise("exact"))


def by_lines(words: DataFrame, fields: DataFrame, **options) -> DataFrame:
    """Each line of a value is looked for by itself, without overlaps; the hits are merged."""
    rows = fields.select("doc_id", "field_ord", "field_name", F.explode(text.lines(F.col("field_value"))).alias("field_value"))
    return merge_adjacent(without_overlaps(exact(words, rows, **options)))


def lowest_page(matches: DataFrame) -> DataFrame:
    """Of a field's matches on several pages the first page's is kept; filters come before."""
    by = Window.partitionBy(*_KEY).orderBy("page_num", F.desc("confidence"), "word_count", "start_idx")
    return matches.withColumn("rank", F.row_number().over(by)).where("rank = 1").drop("rank")


def routed(words: DataFrame, fields: DataFrame, strategy: str = "auto", multiline: bool = True, least: float = 80.0, contiguous: bool = False, normal=text.match_text) -> DataFrame:
    """Values with line breaks go by lines first; the others, and those without a hit, by the strategy.

    Strategies: ``exact``, ``fuzzy``, ``auto``, and ``multiline``, by which every value goes by lines and by nothing else.
    """
    plans = {"exact": lambda f: first_match(exact(words, f, normal, contiguous)), "fuzzy": lambda f: first_match(fuzzy(words, f, least, normal=normal)), "auto": lambda f: auto(words, f, least, normal, contiguous)}
    cols = ["doc_id", "field_ord", "field_name", "matched_text", "bbox", "page_num", "confidence", "match_type"]
    if not multiline and strategy != "multiline":
        return plans[strategy](fields).select(cols)
    many = fields if strategy == "multiline" else fields.where(F.col("field_value").rlike(r"[\r\n]"))
    by = Window.partitionBy(*_KEY).orderBy(F.desc("n_merged"), "page_num", "island")
    found = by_lines(words, many, normal=normal, contiguous=contiguous).withColumn("rank", F.row_number().over(by)).where("rank = 1").select(cols)
    if strategy == "multiline":
        return found
    return found.unionByName(plans[strategy](fields.join(found.select(*_KEY), _KEY, "left_anti")).select(cols))
