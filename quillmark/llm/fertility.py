"""Quality rule on tokeniser fertility: characters per token, byte-fallback share, token entropy."""

from __future__ import annotations

import base64
import json
import math
import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Band:
    """What a text of a language or script must measure to be kept."""

    chars_per_token: tuple[float, float]
    max_byte_share: float = 0.10
    min_entropy: float = 4.75


@dataclass(frozen=True)
class Bands:
    """``by_lang`` goes first, in any case of letters, then ``by_script`` of most letters.

    Means over few tokens vary more: below ``full`` tokens a band is wider by
    ``spread`` (in characters a token) and ``byte_spread`` times the growth of a
    mean's deviation, and the entropy asked for is at most ``fill`` of what so
    many tokens can have.
    """

    by_lang: dict[str, Band] = field(default_factory=dict)
    by_script: dict[str, Band] = field(default_factory=dict)
    full: int = 128
    spread: float = 9.0
    byte_spread: float = 1.5
    fill: float = 0.8

    def of(self, lang: str | None, script: str) -> Band | None:
        return self.by_lang.get((lang or "").lower()) or self.by_script.get(script)

    def keeps(self, lang: str | None, script: str, tokens: int, chars: float, byte_share: float, entropy: float) -> bool:
        """Whether a text's measures lie in its band; true without a band."""
        band = self.of(lang, script)
        if not band or not tokens:
            return True
        more = max(0.0, tokens**-0.5 - self.full**-0.5)
        low, high = band.chars_per_token
        enough = min(band.min_entropy, self.fill * math.log2(tokens))
        return low - self.spread * more <= chars <= high + self.spread * more and byte_share <= band.max_byte_share + self.byte_spread * more and entropy >= enough


BY_SCRIPT = {"latin": Band((1.9, 6.0)), "cyrillic": Band((1.5, 5.0)), "greek": Band((0.9, 4.0)), "han": Band((0.35, 2.5), 0.9), "kana": Band((0.5, 2.5), 0.7), "hangul": Band((0.3, 2.5), 0.9), "arabic": Band((0.7, 4.0), 0.5), "other": Band((0.2, 8.0), 1.0)}
#: For piece_bpe_32k.model; from the one-per-cent points of labelled good texts.
BANDS = Bands(by_lang={"en": Band((2.42, 5.5)), "de": Band((2.40, 5.5)), "es": Band((2.13, 5.5)), "fr": Band((2.19, 5.5))}, by_script=BY_SCRIPT)
#: For byte_bpe_multi_50k.tiktoken, in the same way.
MULTI_BANDS = Bands(by_lang={"en": Band((2.45, 5.5)), "de": Band((2.50, 5.5)), "es": Band((2.25, 5.5)), "fr": Band((2.20, 5.5))}, by_script=BY_SCRIPT)

#: First and last code points of the scripts told apart.
SCRIPTS = {
    "latin": ((0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x24F)),
    "greek": ((0x370, 0x3FF),),
    "cyrillic": ((0x400, 0x52F),),
    "arabic": ((0x600, 0x6FF),),
    "kana": ((0x3040, 0x30FF),),
    "han": ((0x3400, 0x9FFF),),
    "hangul": ((0xAC00, 0xD7AF),),
}
_SCRIPT_RE = {k: re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in v) + "]") for k, v in SCRIPTS.items()}
_LATIN = re.compile("[^\x00-ɏ]")


def script_of(text: str) -> str:
    """The script with most letters, in the order listed among equals; ``other`` without any."""
    if not _LATIN.search(text):
        return "latin" if _SCRIPT_RE["latin"].search(text) else "other"
    counts = {k: len(r.findall(text)) for k, r in _SCRIPT_RE.items()}
    best = max(counts, key=counts.get)
    return best if counts[best] else "other"


def repeated_words(parts: list[bytes], width: int = 8) -> int:
    """Words that lie in a window of ``width`` (a power of two) words found twice or more in the text."""
    n = len(parts)
    if n <= width or len(seen := dict.fromkeys(parts)) == n:
        return 0
    number = {w: i for i, w in enumerate(seen)}
    ids = np.fromiter(map(number.__getitem__, parts), np.int64, n)
    step = 1
    while step < width:  # ids of windows of twice the length, by pairs
        _, ids = np.unique(ids[:-step] * (n + 1) + ids[step:], return_inverse=True)
        step *= 2
    twice = np.bincount(ids)[ids] > 1
    if not twice.any():
        return 0
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, np.flatnonzero(twice), 1)
    np.add.at(cover, np.flatnonzero(twice) + width, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode()
    parts = raw.split()
    spaces = len(raw) - len(raw.translate(None, b" \t\n\x0b\x0c\r"))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(parts), len(text) - spaces, len(raw) - len(raw.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(parts)


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes as: printable Latin-1 as itself, the rest in order from U+0100."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(b for b in range(256) if b not in set(plain))}


def _broken(piece: bytes) -> bool:
    """Whether bytes are no whole characters, so that a token of them falls back to bytes."""
    try:
        piece.decode()
    except UnicodeDecodeError:
        return True
    return False


class Vocabulary:
    """Token numbers of texts, and which tokens fall back to bytes: byte pieces, parts of characters, unknown ones. For .model, .json and .tiktoken files."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            import sentencepiece

            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda texts: sp.encode(texts, num_threads=1)
            single = [sp.is_byte(i) or sp.is_unknown(i) for i in range(sp.get_piece_size())]
        elif path.endswith(".tiktoken"):
            import public_tokenizers
            import tiktoken

            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.encode = lambda texts: [coder.encode_ordinary(x) for x in texts]
            single = [False] * (max(ranks.values()) + 1)
            for piece, i in ranks.items():
                single[i] = _broken(piece)
        else:
            from tokenizers import Tokenizer

            t = Tokenizer.from_file(path)
            t.encode_special_tokens = True
            self.encode = lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
            vocab, letters, about = t.get_vocab(), byte_letters(), json.loads(t.to_str())
            unknown = about["model"].get("unk_token")
            byte_level = "ByteLevel" in json.dumps([about.get("pre_tokenizer"), about.get("decoder")])
            end = about["model"].get("end_of_word_suffix") or ""
            single = [False] * (max(vocab.values()) + 1)
            for piece, i in vocab.items():
                core = piece.removesuffix(end) if end else piece
                single[i] = piece == unknown or byte_level and all(c in letters for c in core) and _broken(bytes(letters[c] for c in core))
        self.single = np.array(single)

    def measures(self, texts: list[str]) -> list[tuple[int, float, float, float]]:
        """Per text: tokens, characters per token, share of byte tokens, bits of entropy of its tokens."""
        out = []
        for text, ids in zip(texts, self.encode(texts), strict=True):
            n = len(ids)
            if not n:
                out.append((0, 0.0, 0.0, 0.0))
                continue
            counts = np.bincount(np.array(ids, np.int32))
            used = np.flatnonzero(counts)
            c = counts[used]
            p = c / n
            out.append((n, len(text) / n, float(c[self.single[used]].sum()) / n, float(-(p * np.log2(p)).sum())))
        return out


_vocabularies: dict[str, Vocabulary] = {}


def fertility_rule(docs: DataFrame, vocabularies: dict[str, str], bands: dict[str, Bands], slice_texts: int = 64) -> DataFrame:
    """Measures each text by each named vocabulary file and judges it.

    Returns ``doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, script`` and, for each vocabulary,
    ``<name>_tokens, <name>_chars_per_token, <name>_byte_share, <name>_entropy``.
    ``base_failed``: fewer than 20 words, or over 30 % repeated ones. ``kept``
    is false for these, and for texts outside the band of any vocabulary that
    has bands for it.

    A map without a shuffle. Null and empty texts have no words, so they fail;
    without a column ``lang`` the script's bands hold. Repeated rows are judged
    each; other columns are neither read nor returned.
    """
    names = list(vocabularies)
    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, script string"
    schema += "".join(f", {v}_tokens long, {v}_chars_per_token double, {v}_byte_share double, {v}_entropy double" for v in names)

    def start():
        loaded = []
        for v in names:
            if vocabularies[v] not in _vocabularies:
                _vocabularies[vocabularies[v]] = Vocabulary(vocabularies[v])
            loaded.append(_vocabularies[vocabularies[v]])

        def work(ids, texts, langs):
            rows = []
            for at in range(0, len(texts), slice_texts):  # few texts' token lists at a time
                part = [t or "" for t in texts[at : at + slice_texts]]
                measured = [v.measures(part) for v in loaded]
                for k, text in enumerate(part):
                    base = base_counts(text)
                    failed = base[0] < 20 or 100 * base[4] > 30 * base[0]
                    script, kept, more = script_of(text), not failed, []
                    for name, m in zip(names, measured, strict=True):
                        n, chars, byte_share, entropy = m[k]
                        more += m[k]
                        if kept and name in bands:
                            kept = bands[name].keeps(langs[at + k], script, n, chars, byte_share, entropy)
                    rows.append((ids[at + k], *base, failed, kept, script, *more))
            return list(zip(*rows, strict=True))

        return work

    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    return map_rows(docs.select("doc_id", "text", lang.alias("lang")), ["doc_id", "text", "lang"], start, schema)
