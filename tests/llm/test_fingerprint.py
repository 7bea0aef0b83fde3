import hashlib
import random

import numpy as np

from oncallmart.llm import fingerprint as P


def brute_sketch(text):
    """The parse of one text, symbol by symbol."""
    slots = [None] * P.SLOTS
    symbols = [ord(c) for c in text]
    mask = (1 << 64) - 1

    def mix(x):
        return int(P.mix(np.array([x & mask], np.uint64))[0])

    def toss(before, own):
        low = ((before ^ own) & -(before ^ own)).bit_length() - 1
        return 2 * low + (own >> low & 1)

    for turn in range(P.ROUNDS if text else 0):
        runs = []
        for s in symbols:
            if runs and runs[-1][0] == s:
                runs[-1][1] += 1
            else:
                runs.append([s, 1])
        symbols = [s if n == 1 else mix(s + (n << 32)) for s, n in runs]
        labels = symbols
        for _ in range(3):
            labels = [toss(labels[k - 1] if k else labels[0] ^ 1, labels[k]) for k in range(len(labels))]
        names, phrase = [], []
        for k, s in enumerate(symbols):
            after = labels[k + 1] if k + 1 < len(labels) else -1
            if k and labels[k] > labels[k - 1] and labels[k] >= after:
                names.append(phrase)
                phrase = []
            phrase.append(s)
        names.append(phrase)
        symbols = [
            mix(len(p) + sum(s * int(P.PLACES[i % 16]) for i, s in enumerate(p))) for p in names
        ]
        if turn or len(symbols) < P.SHORT:
            for s in symbols:
                value = mix(s ^ (turn + 1))
                slot = value % P.SLOTS
                slots[slot] = value if slots[slot] is None else min(slots[slot], value)
    return [0 if v is None else max(mix(v) >> 48, 1) for v in slots]


def test_sketch_is_the_parse():
    dice = random.Random(1)
    texts = ["", "a", "aaaa", "ab" * 50, "é😀" * 9, "x" * 3000 + "yz"]
    texts += ["".join(dice.choice("abcd é") for _ in range(dice.randint(1, 400))) for _ in range(40)]
    assert P.sketch(texts).tolist() == [brute_sketch(t) for t in texts]


def test_equal_inside_wherever_it_lies():
    dice = random.Random(2)
    text = "".join(dice.choice("abcdefgh ") for _ in range(4000))
    for shift in ("q", "pqrst", "z" * 41):
        assert P.likeness(P.sketch([text]), P.sketch([shift + text]))[0] > 0.8
    other = "".join(dice.choice("abcdefgh ") for _ in range(4000))
    assert P.likeness(P.sketch([text]), P.sketch([other]))[0] < 0.2


def brute(rows):
    rows = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else P.LEAST), r[1] is not None, r[1] or ""))
    out = []
    for k, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(k + 1) % len(rows)][1] or ""
        edited = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        a, b, c = (P.sketch([t]) for t in (text, edited, following))
        out.append((
            doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), P.as_text(a)[0], P.as_text(b)[0],
            float(P.likeness(a, b)[0]), float(P.likeness(a, c)[0]),
        ))
    return sorted(out, key=str)


def test_whole_table(spark, small, monkeypatch):
    monkeypatch.setattr(P, "TASK_ROWS", 17)
    documents = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    got = sorted((tuple(r) for r in P.fingerprints(documents).collect()), key=str)
    assert got == brute([tuple(r) for r in documents.collect()])


def test_hard_rows(spark, hard, empty):
    got = sorted((tuple(r) for r in P.fingerprints(hard).collect()), key=str)
    assert got == brute([(r.doc_id, r.text) for r in hard.collect()])
    assert P.fingerprints(empty).collect() == []
    one = spark.createDataFrame([(5, "a b c")], "doc_id long, text string")
    assert P.fingerprints(one).first().near_next == 1.0
