import math
import random
from collections import Counter

import pytest

from quillmark.llm import bpe, fertility, piece_model, sentencepiece_ac

MODEL = piece_model.default_model()
ODD = ["", " ", "a", "  a  b ", "a\n\nb", "\tx", "ＡＢ ﬁ", "<s>x</s><unk>", "a▁b", "\x00a", "日本語 テキスト", "🙂🙂 é è", "a" * 3000, "ab " * 500, "  \n  ", "word\n word", " \n"]


def rows(spark, texts, extra=""):
    return spark.createDataFrame([(i, t, "z", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, n_tokens int")


def some_texts():
    r = random.Random(5)
    parts = ["the", " ", "\n", "Tion", "é", "ß", "%%%", "12", "  ", "▁", "日", "|", "hello", "..."]
    return ODD + ["".join(r.choice(parts) for _ in range(r.randrange(60))) for _ in range(150)]


def test_counts_equal_the_library(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = some_texts()
    got = {r.doc_id: r for r in bpe.count_tokens(rows(spark, [*texts, None, texts[3]]), MODEL, limit=100).collect()}
    for i, t in enumerate(texts):
        assert (got[i].n_tokens, got[i].n_bytes) == (len(sp.encode(t)), len(t.encode())), repr(t)
        assert got[i].over_limit == (len(sp.encode(t)) > 100)
    assert got[len(texts)].n_tokens == 0 and got[len(texts)].n_bytes == 0
    assert len(got) == len(texts) + 2


def test_small_cache_gives_the_same():
    big, small = bpe.Counter(MODEL), bpe.Counter(MODEL, cache_spans=2)
    assert [big(t) for t in some_texts()] == [small(t) for t in some_texts()]


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.count_tokens(none, MODEL).count() == 0
    assert sentencepiece_ac.round_trip(none, MODEL).count() == 0
    assert fertility.fertility_rule(none, {"piece": MODEL}, {}).count() == 0


def viterbi(pieces, text):
    best = [(0.0, [])] + [(-math.inf, None)] * len(text)
    for stop in range(1, len(text) + 1):
        found = [(best[s][0] + pieces.scores[text[s:stop]], stop - s, s) for s in range(max(0, stop - 20), stop) if text[s:stop] in pieces.scores]
        if found:
            value, _, s = max(found)
            best[stop] = (value, best[s][1] + [pieces.ids[text[s:stop]]])
        else:
            raw = text[stop - 1].encode()
            best[stop] = (best[stop - 1][0] + sentencepiece_ac.BYTE_SCORE * len(raw), best[stop - 1][1] + [pieces.byte_ids[b] for b in raw])
    return best[-1][1]


def test_viterbi_equals_plain_dynamic_programme():
    enc = sentencepiece_ac.Encoder(MODEL)
    for t in some_texts():
        if len(t) < 400:
            whole = piece_model.SPACE + t.replace(" ", piece_model.SPACE) if t else ""
            assert list(enc.encode(t)) == viterbi(enc.pieces, whole), repr(t)


def test_round_trip(spark):
    texts = some_texts()
    got = sentencepiece_ac.round_trip(rows(spark, [*texts, None]), MODEL).collect()
    # a mark of the vocabulary inside a text is decoded as the space it stands for
    assert all(r.same or "▁" in texts[r.doc_id] for r in got)
    enc = sentencepiece_ac.encode(rows(spark, texts), MODEL)
    back = {r.doc_id: r.text for r in sentencepiece_ac.decode(enc, MODEL).collect()}
    assert all(back[i] == t.replace("▁", " ") for i, t in enumerate(texts))


def repeated(parts, width=8):
    grams = [tuple(parts[i : i + width]) for i in range(len(parts) - width + 1)]
    c = Counter(grams)
    return len({i + k for i, g in enumerate(grams) if c[g] > 1 for k in range(width)})


def test_base_counts():
    r = random.Random(3)
    for _ in range(200):
        parts = [r.choice("ab") for _ in range(r.randrange(40))]
        text = "".join(p + r.choice([" ", "\n", "\t", " \x0b", "\r\n"]) for p in parts)
        n, chars, symbols, dup, rep = fertility.base_counts(text)
        assert (n, chars, rep) == (len(parts), sum(map(len, parts)), repeated(parts))
        lines = [x for x in text.split("\n") if x.split()]
        assert dup == len(lines) - len(set(lines))
    assert fertility.base_counts("a# b|<>\xa0 é") == (2, 9, 4, 0, 0)
    assert fertility.base_counts(None) == (0, 0, 0, 0, 0)


def test_fertility_rule(spark):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    r = random.Random(1)
    good = " ".join("".join(r.choice(["tion", "er", "an", "the", "st", "ou", "in", "al", "re", "mo", "ck", "ply"]) for _ in range(r.randrange(1, 4))) for _ in range(300))
    junk = " ".join(f"word{i}%%% $$$" for i in range(200))
    texts = [good, junk, None, "", "a " * 500, "short text"]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in fertility.fertility_rule(df, {"piece": MODEL}, {"piece": fertility.BANDS}).collect()}
    assert got[0].kept and not any(got[i].kept for i in range(1, 6))
    assert [got[i].base_failed for i in range(6)] == [False, False, True, True, True, True]
    ids = sp.encode(good)
    p = [c / len(ids) for c in Counter(ids).values()]
    assert got[0].piece_tokens == len(ids) and got[0].piece_entropy == pytest.approx(-sum(x * math.log2(x) for x in p))
    assert got[0].script == "latin" and fertility.script_of("привет мир") == "cyrillic" and fertility.script_of("123") == "other"


def test_byte_share_of_each_kind_of_vocabulary():
    texts = ["hello world\n\nnext line\n", "日本", "", "naïve"]
    for name in ("byte_bpe_50k.json", "byte_bpe_multi_50k.tiktoken", "word_bpe_49k.json", "piece_bpe_32k.model"):
        got = fertility.Vocabulary(piece_model.default_path(name)).measures(texts)
        assert got[2] == (0, 0.0, 0.0, 0.0) and got[0][0] > 0
        # spaces are whole characters; a line feed is a byte piece of the piece model
        assert got[0][2] == 0 or name.startswith("piece") and got[0][2] == pytest.approx(3 / got[0][0])
    share = {n: fertility.Vocabulary(piece_model.default_path(n)).measures(["日本"])[0][2] for n in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken")}
    assert share == {"byte_bpe_50k.json": 1.0, "byte_bpe_50k.tiktoken": 1.0, "byte_bpe_multi_50k.tiktoken": 0.0}


def test_short_texts_are_judged_too():
    bands = fertility.Bands({"en": fertility.Band((2.4, 5.5), 0.1, 4.75)})
    assert bands.keeps("EN", "latin", 40, 3.5, 0.0, 4.6) and bands.keeps("xx", "other", 40, 9.0, 1.0, 0.0)
    for bad in ((40, 1.5, 0.0, 4.6), (40, 3.5, 0.5, 4.6), (40, 3.5, 0.0, 2.0), (200, 2.3, 0.0, 5.5)):
        assert not bands.keeps("en", "latin", *bad)


def test_verdicts_equal_plain_ones(spark):
    r = random.Random(12)
    rows = []
    for i in range(60):
        unit = r.choice(["tion", "the", "x%$", "été", "日本", "zq7"])
        word = lambda unit=unit: "".join(r.choice([unit, "er", "an", "st", "ou", "in", "al", "re", "mo", "ck", "ply"]) for _ in range(r.randrange(1, 4)))
        rows.append((i, " ".join(word() for _ in range(r.choice([5, 25, 60, 400]))), r.choice(["en", "EN", "fr", None])))
    files = {"piece": MODEL, "multi": piece_model.default_path("byte_bpe_multi_50k.tiktoken")}
    bands = {"piece": fertility.BANDS, "multi": fertility.MULTI_BANDS}
    got = {x.doc_id: x for x in fertility.fertility_rule(spark.createDataFrame(rows, "doc_id long, text string, lang string"), files, bands).collect()}
    for i, text, lang in rows:
        n, _, _, _, again = fertility.base_counts(text)
        kept = n >= 20 and 100 * again <= 30 * n
        for name, path in files.items():
            kept = kept and bands[name].keeps(lang, fertility.script_of(text), *fertility.Vocabulary(path).measures([text])[0])
        assert (got[i].kept, got[i].base_failed) == (kept, n < 20 or 100 * again > 30 * n)
    assert 5 < sum(x.kept for x in got.values()) < 55
