import random

import numpy as np

import corpus_pipeline
from quillmark.llm import near_copies


def plain_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def plain_least(rows):
    """The least id of each row's group, all pairs compared."""
    sets, root = [plain_set(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] | sets[j])
            if sets[i] == sets[j] or len(sets[i] & sets[j]) >= 0.8 * both > 0:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(doc, least.get(find(i), doc))
    return {(doc, least[find(i)]) for i, (doc, _) in enumerate(rows)}


def corpus():
    r = random.Random(3)
    rows = []
    for n in [8, 30, 60, 120, 120, 400, 400, 900] * 6:
        base = [f"w{r.randrange(4000)}" for _ in range(n)]
        for changes in (0, 0, max(1, n // 60), n // 45, n // 20):  # at 0.8 or above, near it, and below
            copy = list(base)
            for at in r.sample(range(n), changes):
                copy[at] = "CHANGED"
            rows.append((len(rows), r.choice([" ", "\n"]).join(copy)))
    return rows + [(9000, None), (9001, ""), (9002, "One two"), (9003, "one TWO"), (9004, "one two three")]


def test_equals_all_pairs(spark):
    rows = corpus()
    df = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, key int").repartition(5)
    want = plain_least(rows)
    got = {(r.doc_id, r.component_id) for r in near_copies.classified(df).collect()}
    assert got == want and 60 < sum(a != b for a, b in want) < len(rows) - 60
    kept = near_copies.one_of_each(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {b for _, b in want}


def test_large_group_takes_few_pairs(spark):
    r = random.Random(5)
    base = [f"w{k}" for k in range(80)]
    rows = [(k, " ".join([*base[:at], f"own{k}", *base[at + 1 :]])) for k in range(600) for at in [r.randrange(80)]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    same, keys = np.zeros(3000, np.int64), np.arange(3000)
    assert len(near_copies.nearest_pairs(same + 3000, same, keys, [same, same])[0]) <= 2 * 3000
    assert {x.component_id for x in near_copies.classified(df).collect()} == {0}


def postings(r, n):
    """Postings of a few lists whose members differ in few bits, with roots and sizes."""
    end, bits = np.repeat([n // 8, n // 4, n], [n // 8, n // 8, n - n // 4]), [np.array([sum(1 << b for b in r.sample(range(64), r.randrange(4))) for _ in range(n)], np.uint64).view(np.int64) for _ in range(4)]
    size = np.array([r.randrange(90, 110) for _ in range(n)])
    return end, np.repeat([9 << 16, 7 << 16, 5 << 16], [n // 8, n // 8, n - n // 4]), np.array(r.sample(range(10 * n), n)), bits, np.array([r.choice([1, 1, 1, r.randrange(2, 9)]) for _ in range(n)]), size, size - np.array([r.randrange(0, 22) for _ in range(n)])


def test_apart_pairs_leave_out_only_what_cannot_be_similar(monkeypatch):
    monkeypatch.setattr(near_copies, "_first_shared", lambda bits, i, j, combos: np.full(len(i), -1))
    end, slot, key, bits, root, size, common = postings(random.Random(4), 1600)
    want = set()
    for i in range(len(key)):
        for j in range(i):
            both = min(common[i], common[j])
            if end[i] == end[j] and root[i] != root[j] and both >= 0.8 * (size[i] + size[j] - both) and sum((int(x[i] ^ x[j]) % 2**64).bit_count() for x in bits) <= 12:
                want.add((min(key[i], key[j]), max(key[i], key[j])))
    got = set(zip(*near_copies.apart_pairs(end, slot, key, bits, root, size, common, near_bits=12), strict=True))
    assert got == want and len(want) > 50


def test_a_pair_is_told_by_one_of_its_lists():
    r = np.random.RandomState(3)
    one = r.randint(0, 256, 64, np.uint8)
    other = one.copy()
    other[np.arange(3, 64, 4)] ^= 1
    for combos in (near_copies.TWO, near_copies.THREE):
        slots, bits = near_copies._slots([one.tobytes(), other.tobytes()], combos)
        shared = np.flatnonzero(slots[0] == slots[1])
        first = near_copies._first_shared(list(bits.T), np.array([0]), np.array([1]), combos)[0]
        assert len(shared) and (first in shared or first == -1) and (slots[0][shared] >> 8 * len(combos[0]) == shared).all()


def test_lists_dealt_out_and_three_byte_postings_change_nothing(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = plain_least(rows)
    for options in ({"hot": 3}, {"wide": 10}):
        assert {(r.doc_id, r.component_id) for r in near_copies.classified(df, **options).collect()} == want


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, KEY string, a int, root int")
    assert near_copies.one_of_each(empty).collect() == []
    df = spark.createDataFrame([(1, "a b c d e f", "k", 1, 2), (2, "a b c d e f", "k", 1, 2), (None, "a b c d e f", "k", 1, 2)], empty.schema)
    assert sorted(str(r.doc_id) for r in near_copies.one_of_each(df).collect()) == ["1", "None"]


def test_the_stage_takes_planted_near_copies(spark, tmp_path):
    r = random.Random(7)
    bases = [[f"w{r.randrange(900)}" for _ in range(150)] for _ in range(20)]
    rows = [(k, " ".join(b)) for k, b in enumerate(bases)] + [(100 + k, " ".join([*b[:40], "altered", *b[41:100], "twice", *b[101:]])) for k, b in enumerate(bases)]
    df = spark.createDataFrame([(i, t, "en", "x", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, df, str(tmp_path)).collect()} == set(range(20))


def tables(monkeypatch):
    """The rows of each table that near_copies writes from here on."""
    rows, write = [], near_copies.materialise

    def counted(df, name):
        out = write(df, name)
        rows.append((name, out.count()))
        return out

    monkeypatch.setattr(near_copies, "materialise", counted)
    return rows


def test_near_texts_that_are_not_similar_give_no_pairs(spark, monkeypatch):
    """A group whose members are all near to each other, but below the similarity, costs rows by its size and not by its square."""
    r = random.Random(8)
    base, rows = [f"w{k}" for k in range(120)], []
    for k in range(400):
        copy = list(base)
        for at in r.sample(range(5, 115), 2):
            copy[at] = f"own{k}"
        rows.append((k, " ".join(copy)))
    want = plain_least(rows)
    written = tables(monkeypatch)
    got = {(x.doc_id, x.component_id) for x in near_copies.classified(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want and max(n for _, n in written) <= 20 * len(rows), written


def test_rows_do_not_grow_with_the_number_of_parts(spark, monkeypatch):
    r = random.Random(9)
    bases = [[f"w{r.randrange(9000)}" for _ in range(1500)] for _ in range(40)]
    rows = [(2 * k + c, " ".join([*b[:700], *["altered"] * c, *b[700 + c :]])) for k, b in enumerate(bases) for c in (0, 1)]
    monkeypatch.setattr(near_copies, "PART_ROWS", 2000)
    written = tables(monkeypatch)
    got = {(x.doc_id, x.component_id) for x in near_copies.classified(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(i, i - i % 2) for i, _ in rows} and max(n for _, n in written) <= 20 * len(rows), written


def connected(a, b):
    root = {x: x for x in [*a, *b]}
    for x, y in zip(a, b, strict=True):
        old, new = root[x], root[y]
        root = {k: new if v == old else v for k, v in root.items()}
    return {frozenset(k for k, v in root.items() if v == x) for x in set(root.values())}


def test_near_roots_connect_what_all_pairs_connect(monkeypatch):
    monkeypatch.setattr(near_copies, "_first_shared", lambda bits, i, j, combos: np.full(len(i), -1))
    for n, seed in ((1600, 4), (400, 5)):
        end, slot, key, bits, _, size, _ = postings(random.Random(seed), n)
        root = key // 3
        want = connected(*(x.tolist() for x in near_copies.apart_pairs(end, slot, root, bits, root, size, size, near_bits=2)))
        a, b = near_copies.near_roots(end, slot, key, bits, root, size, near_bits=2)
        assert connected(a.tolist(), b.tolist()) == want and len(want) > 1 and len(a) > 10


def test_pieces_of_a_class_change_nothing(spark, monkeypatch):
    rows = corpus()
    r = random.Random(6)
    base = [f"w{k}" for k in range(90)]
    for k in range(200):
        at = r.randrange(90)
        rows.append((10_000 + k, " ".join([*base[:at], f"own{k}", *base[at + 1 :], *[f"tail{r.randrange(40)}" for _ in range(r.randrange(12))]])))
    want = plain_least(rows)
    # what the first pass verifies is taken away, so that all is left to the pieces
    monkeypatch.setattr(near_copies, "LIKELY_BITS", -1)
    monkeypatch.setattr(near_copies, "PIECE", (3000, 3000))
    for reach in (near_copies.LONG_LIST, 4):
        monkeypatch.setattr(near_copies, "LONG_LIST", reach)
        assert {(x.doc_id, x.component_id) for x in near_copies.classified(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == want
