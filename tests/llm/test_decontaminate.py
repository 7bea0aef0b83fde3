import random

import numpy as np

from oncallmart.llm import decontaminate as D
from oncallmart.llm import words as W


def shingles(text):
    words = (text or "").encode().lower().split()
    size = min(5, len(words))
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if words else set()


def windows(text):
    """Runs of fewer than five words, which short items are looked for in."""
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + w]) for w in range(1, 5) for k in range(len(words) - w + 1)}


def brute(documents, items):
    sets, wanted = {}, {}
    for i, t in documents:
        sets.setdefault(i, set()).update(shingles(t) | windows(t))
    for i, t in items:
        wanted.setdefault(i, set()).update(shingles(t))
    return sorted(
        (d, i, len(w), len(s & w))
        for d, s in sets.items() for i, w in wanted.items()
        if d is not None and i is not None and w and 100 * len(s & w) >= 80 * len(w)
    )


def found(documents, items):
    return sorted(tuple(r)[:4] for r in D.contained(documents, items).collect())


def test_items_of_all_sizes_in_long_documents(spark):
    dice = random.Random(4)
    word = lambda: "w%d" % dice.randrange(10**6)
    items = [(k, " ".join(word() for _ in range(dice.choice((3, 5, 6, 12, 30, 80))))) for k in range(60)]
    documents = []
    for k in range(300):
        words = [word() for _ in range(dice.choice((0, 10, 300, 4000)))]
        for _, text in dice.sample(items, 2):
            own = text.split()
            if dice.random() < 0.5:
                own[dice.randrange(len(own))] = word()
            at = dice.randrange(len(words) + 1)
            words[at:at] = own
        documents.append((k, " ".join(words)))
    documents += [(1000 + k, t) for k, t in items[:20]]
    docs = spark.createDataFrame(documents, "doc_id long, text string")
    assert found(docs, spark.createDataFrame(items, "item_id long, text string")) == brute(documents, items)


def test_hard_rows(spark, hard, empty):
    items = [(1, "A b  c\td E"), (1, "A b  c\td E"), (2, None), (3, ""), (4, "one two three"), (None, "a b c d e"), (5, "x " * 400)]
    wanted = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as doc_id", "2 as shingle")
    rows = [(r.doc_id, r.text) for r in hard.collect()]
    assert found(hard, wanted) == brute(rows, items)
    assert found(empty, wanted) == found(hard, wanted.limit(0)) == []
    clean = D.clean(hard, wanted)
    leaked = {d for d, *_ in brute(rows, items)}
    assert clean.columns == hard.columns
    assert sorted(map(str, clean.collect())) == sorted(str(r) for r in hard.collect() if r.doc_id not in leaked)


def test_sketch_keeps_the_asked_share():
    dice = np.random.default_rng(1)
    for size in (65, 100, 128, 3000):
        shingles = np.unique(dice.integers(0, 1 << 63, size, dtype=np.uint64))
        for cls in (1, 2, 4):
            kept = np.mean([D.sketched(W.mix(shingles + np.uint64(k)), D.bins_each(D.share(cls, 80))).mean() for k in range(40)])
            assert D.share(cls, 80) - 0.03 < kept <= min(1.0, 2.1 * D.share(cls, 80))
    shares = [D.share(q, 80) for q in range(12)]
    assert shares == sorted(shares, reverse=True) and shares[0] == 1.0 and shares[-1] < 0.01
    assert [D.class_of(n) for n in (1, 15, 16, 31, 32, 64, 1000)] == [0, 0, 1, 1, 2, 3, 6]


def test_classes_of_items_on_spark(spark):
    items = [(n, " ".join(f"w{n}x{k}" for k in range(n + 4))) for n in (1, 15, 16, 31, 32, 63, 64, 200)]
    got = {r.item_id: (r.n_item, r["class"]) for r in D._index(spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == {n: (n, D.class_of(n)) for n, _ in items}


def test_only_sketches_make_candidates(spark, monkeypatch):
    """Without values in the sketches nothing is found; with thin ones recall is as computed."""
    dice = random.Random(11)
    word = lambda: "w%d" % dice.randrange(10**7)
    items = [(k, " ".join(word() for _ in range(36))) for k in range(300)]
    documents = [(k, " ".join([word() for _ in range(500)] + t.split() + [word() for _ in range(300)])) for k, t in items]
    docs, wanted = spark.createDataFrame(documents, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert found(docs, wanted) == brute(documents, items)
    monkeypatch.setattr(D, "MISS", 0.1)
    some = found(docs, wanted)
    # At most a tenth of items contained to 80 % are missed, fewer of those contained whole.
    assert set(some) < set(brute(documents, items)) and len(some) >= 0.9 * len(items)
    monkeypatch.setattr(D, "MISS", 1.0 - 1e-12)
    assert len(found(docs, wanted)) < 0.1 * len(items)


def test_short_items_inside_long_documents(spark):
    items = [(1, "one"), (2, "Two words"), (3, "now three words"), (4, "here are four words"), (5, "absent")]
    long = "x " * 500
    documents = [(k, f"{long}{t} {long}") for k, t in items[:4]] + [(9, "two"), (10, "words two"), (11, "now three words")]
    got = found(spark.createDataFrame(documents, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert got == brute(documents, items) and (2, 2, 1, 1) in got and (11, 3, 1, 1) in got


def test_filter_has_all_items_and_grows_with_them(spark):
    shingles = W.mix(np.arange(5000, dtype=np.uint64))
    rows = spark.createDataFrame([(int(x),) for x in shingles.view(np.int64)], "shingle long")
    size = D.bloom_size(5000)
    bits = D.bloom(rows, size)
    assert len(bits) * 8 == size and D.in_bloom(bits, shingles).all()
    assert D.in_bloom(bits, W.mix(np.arange(10**6, 10**6 + 5000, dtype=np.uint64))).mean() < 0.01
    assert D.bloom_size(0) == D.BLOOM_LEAST < D.bloom_size(10**5) < D.bloom_size(10**6) <= D.bloom_size(10**12) == D.BLOOM_MOST
