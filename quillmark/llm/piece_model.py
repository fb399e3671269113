"""Pieces of a sentencepiece model, and the cut of a text into spans that no piece crosses."""

from __future__ import annotations

import re
from dataclasses import dataclass

SPACE = "▁"
#: A run of space marks with what follows it up to the next mark or line feed.
SPAN = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")


@dataclass(frozen=True)
class Pieces:
    """``scores``: ordinary pieces; ``ids``: their numbers; ``byte_ids``: numbers of the 256 byte pieces."""

    scores: dict[str, float]
    ids: dict[str, int]
    byte_ids: list[int]
    texts: list[bytes]
    unknown: int

    @property
    def separable(self) -> bool:
        """True if no piece has a space mark after another character, or a line feed: spans can then be cut alone."""
        inner = re.compile(f"[^{SPACE}]{SPACE}|\n")
        return not any(inner.search(p) for p in self.scores)


def default_path(name: str) -> str:
    """A public vocabulary file for the registered queries; operators take paths as parameters."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def default_model() -> str:
    return default_path("piece_bpe_32k.model")


def load(model_file: str) -> Pieces:
    """Reads the vocabulary. The file must be at the same path on every executor."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    scores, ids, byte_ids, texts = {}, {}, [-1] * 256, []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(piece[1:-1], 16)] = i
            texts.append(bytes([int(piece[1:-1], 16)]))
        elif sp.is_control(i) or sp.is_unknown(i):
            texts.append(b"")
        else:
            scores[piece], ids[piece] = sp.get_score(i), i
            texts.append(piece.replace(SPACE, " ").encode())
    return Pieces(scores, ids, byte_ids, texts, sp.unk_id())


def spans(text: str) -> list[str]:
    """Escapes spaces, adds the leading space mark and cuts; an empty text has no span."""
    return SPAN.findall(SPACE + text.replace(" ", SPACE)) if text else []
