import random

import numpy as np

from oncallmart.llm import near_dedup as N
from oncallmart.llm import words as W
from oncallmart.llm.components import components


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    size = min(5, len(words))
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


def brute(rows, percent=85):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (a, one) in enumerate(sets):
        for b, two in sets[:k]:
            both = len(one & two)
            if a is not None and b is not None and both and 100 * both >= percent * len(one | two):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return sorted(
        ((i, len(s), i if i is None else root(i), None if i is None else root(i) == i) for i, s in sets), key=str
    )


def edited(dice, words, changes):
    words = list(words)
    for _ in range(changes):
        words[dice.randrange(len(words))] = "w%d" % dice.randrange(10**6)
    return " ".join(words)


def test_families_of_copies(spark):
    """Copies of one text whose links depend on few edits, so hubs alone would lose some."""
    dice = random.Random(5)
    rows = []
    for family in range(6):
        words = ["f%dw%d" % (family, dice.randrange(10**6)) for _ in range(150)]
        for _ in range(60):
            rows.append(edited(dice, words, dice.choice((0, 1, 2, 3, 4, 6))))
    dice.shuffle(rows)
    rows = list(enumerate(rows))
    got = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_hard_rows(hard, empty):
    rows = [(r.doc_id, r.text) for r in hard.collect()]
    assert sorted((tuple(r) for r in N.near_duplicates(hard).collect()), key=str) == brute(rows)
    assert N.near_duplicates(empty).collect() == []
    kept = N.keep_one(hard)
    assert kept.columns == hard.columns
    assert {r.doc_id for r in kept.collect()} == {a for a, _, c, k in brute(rows) if k}


def test_band_misses_are_rare():
    dice = np.random.default_rng(3)
    missed = 0
    for _ in range(400):
        size = int(dice.integers(12, 400))
        union = dice.integers(0, 1 << 63, size, dtype=np.uint64)
        off = int(size * 0.15)
        one, two = np.unique(union[off // 2 :]), np.unique(union[: size - (off - off // 2)])
        a, b = N.band_numbers(N.bin_minima([one, two]))
        missed += not (a == b).any()
        marks = [np.frombuffer(N.sketch(x), np.uint8) for x in (one, two)]
        assert N.may_link(marks[0], len(one), marks[1][None], np.array([len(two)]), 85)[0]
    assert missed == 0


def test_densified_bins_agree_like_the_sets():
    one = np.arange(1, 8, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    a, b = N.densify(N.bin_minima([one, one[:6]]))
    assert 0.65 < (a == b).mean() <= 1
    assert (N.densify(np.full((1, N.BINS), N.EMPTY)) == N.EMPTY).all()


def test_components(spark):
    dice = random.Random(1)
    edges = [(k, k + 1) for k in range(100, 160)] + [(1, 1), (None, 4)]
    edges += [(dice.randrange(200, 400), dice.randrange(200, 400)) for _ in range(150)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted((r.id, r.component) for r in got) == sorted((x, root(x)) for x in parent)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_shingle_numbers_tell_short_texts_apart():
    numbers = W.word_numbers()
    assert len(W.shingles(None, numbers)) == len(W.shingles(b" \n", numbers)) == 0
    assert W.shingles(b"A b c", numbers).tolist() == W.shingles(b"a  B\tc", numbers).tolist()
    assert len(set(W.shingles(b"a b c d e", numbers)) & set(W.shingles(b"a b c d", numbers))) == 0


def test_without_copies_counts_rows(spark):
    """Null ids link with nothing and stay; equal rows of one id become one."""
    text = " ".join(f"w{k}" for k in range(30))
    rows = [
        (1, text), (1, text), (1, text.upper()), (2, text), (1, "quite other words here today"), (None, text), (None, "a b"),
        (3, "a b"), (4, None), (4, None), (5, "x y z"), (5, "x y z"), (6, text), (6, ""),
    ]
    kept = N.without_copies(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted(((i, (t or "").lower()) for i, t in kept.collect()), key=str)
    assert got == sorted(
        [(1, text), (1, "quite other words here today"), (None, text), (None, "a b"), (3, "a b"), (4, ""), (4, ""), (5, "x y z"), (6, "")],
        key=str,
    )


def test_bands_follow_the_threshold():
    assert [N.bands_for(p) for p in (80, 85)] == [35, N.BANDS]
    dice, missed = np.random.default_rng(4), 0
    for _ in range(2000):
        size = int(dice.integers(10, 80)) * 5
        union, off = dice.integers(0, 1 << 63, size, dtype=np.uint64), size // 5
        a, b = N.band_numbers(N.bin_minima([union[off // 2 :], union[: size - (off - off // 2)]], 35 * N.ROWS))
        missed += not (a == b).any()
    assert missed == 0


def test_without_copies_from_80_percent(spark):
    """One word changed inside 50 to 64 words leaves 0.80 to 0.85 of the shingles shared."""
    rows = []
    for n in range(48, 68):
        words = [f"t{n}w{k}" for k in range(n)]
        rows += [" ".join(words), " ".join([*words[:20], "other", *words[21:]])]
    rows = list(enumerate(rows))
    kept = N.without_copies(spark.createDataFrame(rows, "doc_id long, text string"), 80)
    stay = {i for i, _, _, k in brute(rows, 80) if k}
    assert {r.doc_id for r in kept.collect()} == stay
    assert stay != {i for i, _, _, k in brute(rows) if k}
