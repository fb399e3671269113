"""Encoding by an Aho-Corasick automaton over pieces and a single-pass Viterbi, and its exact decoding."""

from __future__ import annotations

import hashlib
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import piece_model
from .common import map_rows

CACHE_SPANS = 250_000
#: Score of a byte piece. Bytes only ever stand for characters that are no piece, so any value below the others will do.
BYTE_SCORE = -1e6


class Encoder:
    """The best-scoring segmentation of a text over the pieces of a vocabulary.

    Among segmentations with equal scores the one whose last piece is longest
    is taken, from the end backwards. Characters that are no piece become byte
    pieces, so decoding gives every text back.
    """

    def __init__(self, model_file: str, cache_spans: int = CACHE_SPANS):
        self.pieces = piece_model.load(model_file)
        if not self.pieces.separable:
            raise ValueError(f"{model_file}: a piece spans a space or a line feed")
        self.automaton = ahocorasick.Automaton()
        for piece, score in self.pieces.scores.items():
            self.automaton.add_word(piece, (len(piece), score, self.pieces.ids[piece]))
        self.automaton.make_automaton()
        self.cache_spans, self.known = cache_spans, {}

    def span(self, text: str) -> tuple[int, ...]:
        """Viterbi over one span. ``iter`` walks the automaton once and yields, along the output links, each piece that ends at a position."""
        n = len(text)
        best = [0.0] + [-1e300] * n
        last: list[tuple[int, int] | None] = [None] * (n + 1)
        ready = 0
        for end, (size, score, piece_id) in self.automaton.iter(text):
            while ready < end:  # positions that no piece ended at
                ready += 1
                if last[ready] is None:
                    self._byte(text, ready, best, last)
            stop = end + 1
            value = best[stop - size] + score
            if value > best[stop] or value == best[stop] and (last[stop] is None or size > last[stop][0]):
                best[stop], last[stop] = value, (size, piece_id)
        for stop in range(ready + 1, n + 1):
            if last[stop] is None:
                self._byte(text, stop, best, last)
        ids, at = [], n
        while at:
            size, piece_id = last[at]
            if piece_id < 0:
                ids += [self.pieces.byte_ids[b] for b in reversed(text[at - 1].encode())]
            else:
                ids.append(piece_id)
            at -= size
        return tuple(reversed(ids))

    def _byte(self, text: str, stop: int, best: list, last: list) -> None:
        best[stop], last[stop] = best[stop - 1] + BYTE_SCORE * len(text[stop - 1].encode()), (1, -1)

    def encode(self, text: str | None) -> array:
        out, known = array("i"), self.known
        for span in piece_model.spans(text or ""):
            ids = known.get(span)
            if ids is None:
                ids = array("i", self.span(span))
                if len(known) >= self.cache_spans:
                    known.clear()
                if len(span) < 64:
                    known[span] = ids
            out += ids
        return out

    def decode(self, ids) -> str:
        """The text of piece numbers; the space that encoding adds in front is taken off."""
        raw = b"".join(map(self.pieces.texts.__getitem__, ids)).decode("utf-8", "replace")
        return raw[1:] if raw.startswith(" ") else raw


def as_lists(found: list[array]) -> pa.Array:
    """Arrays of piece numbers as one Arrow column, without a Python object for each number."""
    offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
    values = np.frombuffer(b"".join(f.tobytes() for f in found), np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(model_file: str, cache_spans: int = CACHE_SPANS) -> Encoder:
    """One encoder for each vocabulary and Python worker."""
    if (key := (model_file, cache_spans)) not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def encode(docs: DataFrame, model_file: str, cache_spans: int = CACHE_SPANS) -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_tokens, piece_ids array<int>``. Null and empty texts have no piece."""

    def start():
        enc = encoder(model_file, cache_spans)

        def work(ids, texts):
            found = [enc.encode(t) for t in texts]
            return ids, [len(t.encode()) if t else 0 for t in texts], [len(f) for f in found], as_lists(found)

        return work

    return map_rows(docs, ["doc_id", "text"], start, "doc_id long, n_bytes long, n_tokens long, piece_ids array<int>")


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """Per row of ``doc_id, piece_ids``: ``doc_id, text``. Null lists give empty texts."""

    def start():
        enc = encoder(model_file)
        return lambda ids, lists: (ids, [enc.decode(x or ()) for x in lists])

    return map_rows(encoded, ["doc_id", "piece_ids"], start, "doc_id long, text string")


def round_trip(docs: DataFrame, model_file: str, cache_spans: int = CACHE_SPANS, with_ids: bool = False) -> DataFrame:
    """Encodes and decodes each text in one pass.

    Returns ``doc_id, n_bytes, n_tokens, ids_sha256, same`` (and ``piece_ids``
    if asked for): the digest is of the piece numbers as little-endian 32-bit
    integers; ``same`` says that the decoded text equals the input (a null text
    counts as empty). It is false only for texts with U+2581, which stands for
    a space in the vocabulary. No shuffle; repeated rows are handled each;
    other columns are neither read nor returned.
    """

    def start():
        enc = encoder(model_file, cache_spans)

        def work(ids, texts):
            found = [enc.encode(t) for t in texts]
            return (
                ids,
                [len(t.encode()) if t else 0 for t in texts],
                [len(f) for f in found],
                [hashlib.sha256(f.tobytes()).hexdigest() for f in found],
                [enc.decode(f) == (t or "") for f, t in zip(found, texts, strict=True)],
                *([as_lists(found)] if with_ids else []),
            )

        return work

    return map_rows(docs, ["doc_id", "text"], start, "doc_id long, n_bytes long, n_tokens long, ids_sha256 string, same boolean" + ", piece_ids array<int>" * with_ids)
