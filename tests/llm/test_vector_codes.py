import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from oncallmart.llm import vector_codes as V
from oncallmart.llm import queries

SHAPE = "vec_id long, embedding array<double>, label int"


def by_hand(rows, parts=4, entries=256, rounds=4, scale=1024):
    """Codes by plain integers: (vec_id, label) of each row to its code and error."""
    kept = [
        (i, label, [math.floor(x * scale) for x in v]) for i, v, label in rows
        if v and all(x is not None and math.isfinite(x) for x in v)
    ]
    width = len(kept[0][2]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, _, v in kept]
    order = sorted((k for k in range(len(kept)) if kept[k][0] is not None), key=lambda k: (kept[k][0], kept[k][2]))
    books = [[cut[k][p] for k in order[:entries]] for p in range(parts)]

    def near(x, book):
        far = [sum((a - b) ** 2 for a, b in zip(x, c)) for c in book]
        return far.index(min(far)), min(far)

    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for c in cut:
                members[near(c[p], books[p])[0]].append(c[p])
            for k, xs in members.items():
                books[p][k] = [sum(col) // len(xs) for col in zip(*xs)]
    out, labels = [], Counter()
    for (i, label, _), c in zip(kept, cut):
        found = [near(c[p], books[p]) for p in range(parts)]
        out.append((i, label, "".join(f"{k:02x}" for k, _ in found), sum(d for _, d in found)))
        labels[label] += out[-1][3]
    text = ",".join(str(x) for book in books for c in book for x in c)
    sha = hashlib.sha256(text.encode()).hexdigest()
    return Counter((i, code, error, labels[label], sha) for i, label, code, error in out)


def found(frame):
    return Counter((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in frame.collect())


def test_given_vectors(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    assert found(queries.QUERIES["op11_vector_codes"](spark, small)) == by_hand(rows)


def test_limbs_are_exact():
    pick = np.random.default_rng(3)
    for top in (1, 1000, 2**24, 2**24 + 1, 2**28, 2**30):
        x = pick.integers(-top, top + 1, (40, 16))
        y = pick.integers(-top, top + 1, (7, 16))
        x[0], y[0] = top, -top
        want = x.astype(object) @ y.astype(object).T
        for bits in (None, 5, 11):
            got = V.dot(x, y, bits)
            assert [[int(v) for v in r] for r in got] == [[int(v) for v in r] for r in want] or top == 2**30
        split = V.limbs(x, 11)
        assert (sum(a.astype(np.int64) << (11 * k) for k, a in enumerate(split)) == x).all()
        assert all(np.abs(a).max() <= 2**11 for a in split)
    assert 16 * (2 ** V.limb_bits(16)) ** 2 <= 2**53
    assert 17 * (2 ** V.limb_bits(17)) ** 2 <= 2**53


def test_nearest_takes_the_first_of_equals_at_every_size():
    pick = random.Random(4)
    for top in (3, 2**20, 2**29, 2**40):
        x = np.array([[pick.randint(-top, top) for _ in range(4)] for _ in range(30)], np.int64)
        entries = np.concatenate([x[:5], x[:5], -x[:5]])
        k, far = V.nearest(x, entries)
        for row, i, d in zip(x.tolist(), k, far):
            each = [sum((a - b) ** 2 for a, b in zip(row, c)) for c in entries.tolist()]
            assert (int(i), int(d)) == (each.index(min(each)), min(each))


HARD = [
    (5, [0.5, -0.25, 1.0, 0.0], 1), (3, [0.1, 0.2, -0.3, 0.4], None), (3, [0.1, 0.2, -0.3, 0.4], None),
    (3, [0.1, 0.1, 0.3, 0.4], 2), (None, [0.7, 0.7, 0.7, -0.7], 1), (None, [0.5, -0.25, 1.0, 0.0], None),
    (9, None, 1), (10, [0.1, None, 0.2, 0.3], 1), (11, [float("nan"), 0.0, 0.0, 0.0], 1),
    (12, [float("-inf"), 0.0, 0.0, 0.0], 1), (13, [], 1), (14, [70000.25, -260000.5, 3.0, -1e-9], 4),
    (15, [3.0e6, -2.0e6, 0.0, 1.0], 4),
]


def test_hard_rows(spark):
    frame = spark.createDataFrame(HARD, SHAPE).selectExpr("*", "1 AS code", "'x' AS error", "2 AS ints", "3 AS of")
    assert found(V.codes(frame)) == by_hand(HARD)


def test_small_codebooks_move_and_unused_entries_stay(spark):
    pick = random.Random(8)
    rows = [(k, [pick.gauss(k % 3, 0.2) for _ in range(6)], k % 2) for k in range(200)]
    rows += [(k, rows[0][1], 0) for k in range(200, 210)]
    whole, books = V.fit(spark.createDataFrame(rows, SHAPE), parts=3, entries=5, rounds=6)
    got = V.with_label_error(V.assign(whole, books)).withColumn("codebooks_sha256", V.F.lit(V.digest(books)))
    assert found(got) == by_hand(rows, 3, 5, 6)
    back = {r.vec_id: r.vector for r in V.restored(V.assign(whole, books), books).collect()}
    error = {r.vec_id: r.error for r in got.collect()}
    ints = {i: [math.floor(x * 1024) for x in v] for i, v, _ in rows}
    for i, v in back.items():
        assert sum((a - round(b * 1024)) ** 2 for a, b in zip(ints[i], v)) == error[i]


def test_many_labels_are_met_in_salted_parts(spark, monkeypatch):
    rows = [(k, [k / 7, 1.0, -k / 3, 0.5], None if k % 3 == 0 else k % 11) for k in range(90)]
    want = by_hand(rows)
    monkeypatch.setattr(V, "FEW_LABELS", 2)
    assert found(V.codes(spark.createDataFrame(rows, SHAPE))) == want


def test_other_lengths_empty_tables_and_refusals(spark):
    rows = [(1, [1.0] * 4, 1), (2, [2.0] * 8, 1), (3, [3.0] * 8, 1), (0, [4.0] * 12, 1)]
    assert found(V.codes(spark.createDataFrame(rows, SHAPE))) == by_hand(rows[1:3])
    none = V.codes(spark.createDataFrame([], SHAPE))
    assert none.collect() == []
    assert none.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert V.codes(spark.createDataFrame([(None, [1.0] * 4, 1)], SHAPE)).collect() == []
    with pytest.raises(ValueError):
        V.fit(spark.createDataFrame([(1, [1.0] * 6, 1)], SHAPE))
    with pytest.raises(ArithmeticError):
        V.fit(spark.createDataFrame([(1, [1e300] * 4, 1)], SHAPE))
