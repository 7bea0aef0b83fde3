import math
import zlib
from collections import Counter

import numpy as np
import pyarrow.compute  # noqa: F401
import pytest

from oncallmart.llm import mixing as M


def brute_base(rows):
    split = [(i, (t or "").encode().lower().split() + [b""]) for i, t in rows]
    held = [zlib.crc32(str(i).encode()) % 5 == 1 if i is not None else False for i, _ in rows]
    counts = Counter(w for (_, words), h in zip(split, held) if not h for w in words)
    n, v = sum(counts.values()), len(counts)
    return sorted(
        (
            (i, h, len(words), sum(counts[w] > 0 for w in words), n,
             sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words))
            for (i, words), h in zip(split, held)
        ),
        key=str,
    )


def check(frame, rows):
    got = sorted((tuple(r)[:6] for r in frame.collect()), key=str)
    want = brute_base(rows)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want])


def test_base_and_gain(spark, small):
    larger = small.replace("0.001", "0.01")
    documents = spark.read.parquet(f"{larger}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in documents.collect()]
    frame = M.score_documents(documents, block_bytes=1_000_000)
    check(frame, rows)
    found = frame.collect()
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_blocks_do_not_change_the_counts(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    one = {r.doc_id: r.score for r in M.score_documents(documents).collect()}
    many = {r.doc_id: r.score for r in M.score_documents(documents, block_bytes=50_000).collect()}
    assert one.keys() == many.keys()
    assert [many[k] for k in one] == pytest.approx([one[k] for k in one], rel=0.02)


def test_hard_rows(hard, empty):
    check(M.score_documents(hard), [(r.doc_id, r.text) for r in hard.collect()])
    assert M.score_documents(empty).collect() == []


def test_only_held_out_rows(spark):
    held = [k for k in range(40) if zlib.crc32(str(k).encode()) % 5 == 1]
    rows = [(k, "some words") for k in held]
    check(M.score_documents(spark.createDataFrame(rows, "doc_id long, text string")), rows)


def test_spelling_is_a_distribution():
    """The bits of one byte, over all 256 values in a fixed place, sum to one."""
    counts = np.zeros((2, len(M.ORDERS) * M.SLOTS), np.float32)
    tokens = [b"the", b"there", b"then", b"other", b"and"] * 3
    M.add_counts(counts, tokens)
    _, _, _, contexts = M.spelling(tokens)
    weights = M.start_weights()
    flat = np.arange(256, dtype=np.uint8)
    start = [np.full(256, c[0]) for c in contexts]
    total = np.zeros(256)
    for k, node, bit in M.bits(flat):
        x, known = M.inputs(counts, start, node, bit, False)
        odds = (x * weights[known * 8 + k].T).sum(axis=0)
        total -= np.logaddexp(0, np.where(bit == 1, -odds, odds))
    assert np.exp(total).sum() == pytest.approx(1, abs=1e-4)
    known, new = M.spelled([b"the", b"xqz"], counts, weights)
    assert known > new


def test_refining_lowers_the_cost():
    words = [a + b for a in (b"th", b"wh", b"st", b"re") for b in (b"ing", b"ed", b"er", b"ion", b"at")] * 20
    counts = np.zeros((2, len(M.ORDERS) * M.SLOTS), np.float32)
    M.add_counts(counts, words)
    weights = M.start_weights()
    better = M.refine(weights, counts, words * 30)
    assert M.spelled(words, counts, better).sum() > M.spelled(words, counts, weights).sum()


def test_order_of_words_counts(spark):
    """A held-out text in the order of the training texts is likelier than its words shuffled."""
    dice = np.random.default_rng(2)
    held = [k for k in range(400) if zlib.crc32(str(k).encode()) % 5 == 1][:2]
    ring = [f"w{k}" for k in range(40)]
    turned = [" ".join(ring[k:] + ring[:k]) for k in dice.integers(0, 40, 200).tolist()]
    shuffled = " ".join(dice.permutation(ring).tolist())
    rows = [(k, t) for k, t in enumerate(turned) if k not in held] + [(held[0], turned[0]), (held[1], shuffled)]
    frame = M.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=4000)
    got = {r.doc_id: r for r in frame.collect()}
    one, two = got[held[0]], got[held[1]]
    assert one.base_score == pytest.approx(two.base_score)
    assert one.score > two.score + 10


def test_pair_totals_are_those_of_all_blocks():
    pairs = [np.array(x, np.uint64) for x in ([1, 5, 9], [5], [2, 9])]
    seen = [np.array(x, np.int64) for x in ([2, 0, 1], [3], [1, 4])]
    found = M._pair_totals(M.pa.table({
        "block": M.pa.array([0, 1, 2], M.pa.int32()), "kind": M.pa.array([7] * 3, M.pa.int32()),
        "pairs": [x.tobytes() for x in pairs], "seen": [x.tobytes() for x in seen],
    }))
    assert [np.frombuffer(x, np.int64).tolist() for x in found.column("counts").to_pylist()] == [[2, 3, 5], [3], [1, 5]]


def test_sources_sum_to_one_after_every_word():
    """Over all tokens after one word, the three frequencies and so their mixture sum to one."""
    stream = np.random.default_rng(1).integers(0, 6, 500)
    c = np.bincount(stream[1:], minlength=6)
    gates = M.start_gates((0.3, 0.3, 0.4))
    for word in range(6):
        pair = np.bincount(stream[1:][stream[:-1] == word], minlength=6)
        parts, gate = M.sources(c, c, np.full(6, 499), pair, np.full(6, pair.sum()), 499, 0)
        assert parts.sum(axis=1) == pytest.approx([1, 1, 1])
        assert gates[gate[0]].sum() == pytest.approx(1)


def test_planes_round_trip():
    for width, most in ((4, 1 << 32), (6, 1 << 48)):
        x = np.random.default_rng(3).integers(0, most, 1000)
        assert M.from_planes(M.planes(x, width), width).tolist() == x.tolist()
    assert M.from_planes(M.planes(np.empty(0, np.int64), 6), 6).tolist() == []


def test_a_range_is_counted_by_its_tokens():
    """Counts of two blocks' tokens by class, and what each block is told, against a counter."""
    asked = {0: [(b"a", 0, 3), (b"", 1, 2), (b"b", 1, 0)], 4: [(b"b", 0, 5), (b"a", 0, 1), (b"a", 1, 7)]}
    found = M._vocabulary(M.pa.table({
        "block": M.pa.array(list(asked), M.pa.int64()), "kind": M.pa.array([2, 2], M.pa.int32()),
        "tokens": [b" ".join(t for t, _, _ in x) for x in asked.values()],
        "kinds": [bytes(k for _, k, _ in x) for x in asked.values()],
        "seen": [M.planes(np.array([n for _, _, n in x]), M.COUNT_BYTES) for x in asked.values()],
    }))
    whole = found.filter(M.pa.compute.equal(found.column("part"), "vocabulary"))
    tokens = whole.column("tokens")[0].as_py().split(b" ")
    spelled = np.arange(len(tokens), dtype=np.float32)
    known = M.pa.table({"kind": whole.column("kind"), "seen": whole.column("seen"), "spelled": [spelled.tobytes()]})
    told = M._answers(found.filter(M.pa.compute.equal(found.column("part"), "answers")), known)
    total, of = Counter(), Counter()
    for rows in asked.values():
        for t, k, n in rows:
            total[t] += n
            of[t, k] += n
    for row in told.to_pylist():
        rows = asked[row["asking"]]
        assert M.from_planes(row["c"], M.COUNT_BYTES).tolist() == [total[t] for t, _, _ in rows]
        assert M.from_planes(row["own"], M.COUNT_BYTES).tolist() == [of[t, k] for t, k, _ in rows]
        assert np.frombuffer(row["spelled"], np.float32).tolist() == [tokens.index(t) for t, _, _ in rows]


@pytest.mark.parametrize("numbers", [[], [7], [5, 5, 5], [9, 2, 2**48 - 1, 0, 9, 2]])
def test_ranks_and_distinct_numbers(numbers):
    x = np.array(numbers, np.uint64)
    expected = sorted(set(numbers))
    assert M.distinct(x).tolist() == expected
    of, many = M.ranks(x)
    assert many == len(expected) and of.tolist() == [expected.index(n) for n in numbers]


def test_pairs_are_not_hashed_into_tables(monkeypatch):
    """`np.unique` without further results hashes every number, at several times the cost of a sort."""
    plain, hashed = np.unique, []

    def unique(x, *further, **named):
        if not further and not named:
            hashed.append(len(x))
        return plain(x, *further, **named)

    monkeypatch.setattr(np, "unique", unique)
    own = M.Numbering(0, np.zeros((M.CLASSES, 256)))
    own.documents(pyarrow.RecordBatch.from_pydict({"doc_id": [1, 2], "held_out": [False, True], "text": ["a b a b", "b a c"]}))
    (row,) = list(own.pairs(1))
    seen = M.from_planes(row.column("seen")[0].as_py(), M.COUNT_BYTES)
    # Start and a, a and b twice, b and a, b and the end; start and b, a and c, c and the end are only asked for.
    assert sorted(seen.tolist()) == [0, 0, 0, 1, 1, 1, 2] and not hashed


def test_contexts_cross_the_borders_of_tokens(spark):
    """Every occurrence in the training texts counts, after the bytes before it, those of other tokens too."""
    held = next(k for k in range(40) if zlib.crc32(str(k).encode()) % 5 == 1)
    texts = {k: ["ab cd ab cd", "xb  cd", "AB\ncd", None][k % 4] for k in range(40) if zlib.crc32(str(k).encode()) % 5 != 1}
    rows = M.pa.RecordBatch.from_pydict(
        {"doc_id": [*texts, held], "held_out": [False] * len(texts) + [True], "text": [*texts.values(), "zb cq"]}
    )
    counts = np.zeros((2, len(M.ORDERS) * M.SLOTS), np.uint32)
    own = M.Numbering(0, np.zeros((M.CLASSES, 256)))
    for begin in range(0, len(rows), 7):
        own.documents(rows.slice(begin, 7))
    own.count(counts)
    want = np.zeros_like(counts)
    for text in texts.values():
        M.add_counts(want, [*(text or "").lower().encode().split(), b""])
    assert (counts == want).all()
    streams = [b" " * M.REACH + b" ".join((t or "").lower().encode().split() + [b""]) + b" " for t in texts.values()]
    # The first byte after "b " follows it in every text that has words: a "c", whatever "b" ends.
    flat, _, place, contexts = M.spelling([b"ab", b"cd", b""])
    at = M.slots_of(contexts[1][3:4], np.array([1], np.uint64)) + M.SLOTS
    assert (flat[3], place[3]) == (ord("c"), 0)
    assert counts[0, at[0]] == sum(s.count(b"b c") for s in streams) and counts[1, at[0]] == 0


def test_a_token_is_spelled_after_the_token_before_it():
    """Both tokens are as frequent, but only one follows "left"; the other follows "right"."""
    counts = np.zeros((2, len(M.ORDERS) * M.SLOTS), np.float32)
    for _ in range(20):
        M.add_counts(counts, [b"left", b"mo", b"right", b"ka", b""])
    texts = [b"left mo ", b"left ka "]
    runs, of = M.numbered(M.grams(texts))
    cost = M.coded(runs, counts, M.start_weights(), [], without_own=False)[1][of].reshape(2, -1).sum(axis=1)
    assert cost[0] > cost[1] + 1


def test_runs_count_as_the_bytes_they_stand_for():
    """Costs of distinct runs, times their occurrences, are those of a walk over every bit of the text."""
    dice = np.random.default_rng(4)
    tokens = [bytes(dice.integers(97, 101, n).astype(np.uint8).tolist()) for n in dice.integers(1, 9, 200).tolist()]
    counts, weights = np.zeros((2, len(M.ORDERS) * M.SLOTS), np.float32), M.start_weights()
    M.add_counts(counts, tokens[:150])
    flat, _, place, contexts = M.spelling(tokens)
    want = np.zeros(len(flat))
    for k, node, bit in M.bits(flat):
        x, known = M.inputs(counts, contexts, node, bit, False)
        odds = (x * weights[place * M.KNOWN * 8 + known * 8 + k].T).sum(axis=0)
        want -= np.logaddexp(0, np.where(bit == 1, -odds, odds))
    runs, of = M.numbered(M.grams([b" ".join(tokens) + b" "]))
    got = M.coded(runs, counts, weights, [], without_own=False)[1][of]
    assert got == pytest.approx(want, abs=1e-4)


def test_large_counts_shrink_alike():
    counts = np.array([[0, 1, 65535, 1 << 20, 3], [7, 65536, 1, 1, 1 << 40]], np.int64)
    got = M.narrow(counts)
    assert got[:, 0].tolist() == [0, 7] and got[:, 2].tolist() == [65535, 1]
    assert ((got > 0) == (counts > 0)).all() and got[0, 3] / got[1, 3] > 30_000
    packed = M.Packed(np.resize(got, (2, M.CHUNK)))
    assert (packed.table() == np.resize(got, (2, M.CHUNK))).all()
