"""Token counts by heap-and-linked-list byte-pair merging; no token identifier is made."""

from __future__ import annotations

from heapq import heapify, heappop, heappush

from pyspark.sql import DataFrame

from . import piece_model
from .common import map_rows

#: Distinct spans whose counts a Python worker keeps.
CACHE_SPANS = 400_000


def merged_count(span: str, scores: dict[str, float]) -> int:
    """Tokens of one span: its initial symbols less the merges made.

    Initial symbols are characters, or the bytes of a character that is no
    piece. The adjacent pair with the best score (lowest rank), leftmost among
    equals, is merged until none is left.
    """
    n = len(span)
    symbols = sum(1 if c in scores else len(c.encode()) for c in span)
    if n == 1:
        return symbols
    part: list[str | None] = list(span)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(-s, i, p) for i in range(n - 1) if (s := scores.get(p := part[i] + part[i + 1])) is not None]
    heapify(heap)
    merges = 0
    while heap:
        _, left, piece = heappop(heap)
        if part[left] is None or (right := after[left]) == n or part[left] + part[right] != piece:
            continue  # one of the two has been merged since
        part[left], part[right] = piece, None
        after[left] = follow = after[right]
        merges += 1
        if follow < n:
            before[follow] = left
            if (s := scores.get(p := piece + part[follow])) is not None:
                heappush(heap, (-s, left, p))
        if (lead := before[left]) >= 0 and (s := scores.get(p := part[lead] + piece)) is not None:
            heappush(heap, (-s, lead, p))
    return symbols - merges


class Counter:
    """Counts of spans, remembered up to a bound; forgetting only costs time."""

    def __init__(self, model_file: str, cache_spans: int = CACHE_SPANS):
        self.pieces = piece_model.load(model_file)
        if not self.pieces.separable:
            raise ValueError(f"{model_file}: a piece spans a space or a line feed")
        self.cache_spans, self.known = cache_spans, {}

    def __call__(self, text: str | None) -> int:
        cut = piece_model.spans(text or "")
        try:
            return sum(map(self.known.__getitem__, cut))
        except KeyError:
            pass
        total, known, scores = 0, self.known, self.pieces.scores
        for span in cut:
            n = known.get(span)
            if n is None:
                n = merged_count(span, scores)
                if len(known) >= self.cache_spans:
                    known.clear()
                if len(span) < 64:
                    known[span] = n
            total += n
        return total


_counters: dict[tuple[str, int], Counter] = {}


def counter(model_file: str, cache_spans: int = CACHE_SPANS) -> Counter:
    """One counter for each vocabulary and Python worker."""
    if (key := (model_file, cache_spans)) not in _counters:
        _counters[key] = Counter(*key)
    return _counters[key]


def count_tokens(docs: DataFrame, model_file: str, limit: int = 4096, cache_spans: int = CACHE_SPANS) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_bytes, n_tokens, over_limit``.

    A map without a shuffle, whatever the skew. Null and empty texts have 0
    tokens; repeated rows are counted each; an empty table gives an empty one;
    other columns are neither read nor returned.
    """

    def start():
        count = counter(model_file, cache_spans)

        def work(ids, texts):
            n = [count(t) for t in texts]
            return ids, [len(t.encode()) if t else 0 for t in texts], n, [x > limit for x in n]

        return work

    return map_rows(docs, ["doc_id", "text"], start, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
