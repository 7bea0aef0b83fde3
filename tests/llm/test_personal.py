import hashlib
import re
from collections import Counter

from oncallmart.llm import personal as P

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    None, "", "none here", "a@b.com", "x a@b.com_c@d.org, e@f", "a@b.com@c.de a@@b.c .@-.- u@h..x u@a.b.", "é😀 me@mail.example.com 你",
    "1.2.3.4.5.6.7.8 1.2.3.400 01.002.0003.255 999.1.1.1.1 1.2.3", "4111 1111 1111 1111 and 4111-1111-1111-1112",
    "4111  1111 1111 1111", "4111111111111111 5500005555555559\u00014111", "0000000000000", "1 2 3 4 5 6 7 8 9 0 1 2 8",
    "+1 (558) 555-1788 +1 555 +12 +1(((9 ++49 30 901820 x +1 2 3 4 5 6 7 8 9 .", "12\u000134 5\u0003a@b\u0003c.d a@b\u0003c",
    "call 555-123-4567 or (555) 123-4567", "mail john (at) example (dot) com today", "card 4111.1111.1111.1111 x",
    "9" * 30000, "1 " * 20000, "a.b@" + "c." * 15000 + "d", "1.2.3.4 " * 3000, "+1 2" * 9000, "a" * 40000, "@" * 9000, "+" * 9000,
]


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def fits(kind, match):
    digits = [c for c in match if c in "0123456789"]
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return {
        k: [f"{k}:{m.start()}:{m.end()}" for m in re.finditer(p, text or "") if fits(k, m.group())]
        for k, p in BASE.items()
    }


def compare(rows, texts):
    for row, text in zip(rows, texts):
        want = brute(text)
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [len(v) for v in want.values()], (text or "")[:80]
        flat = [s for v in want.values() for s in v]
        assert row.base_sha256 == hashlib.sha256(",".join(flat).encode()).hexdigest()
        assert set(flat) <= set(row.spans.split(",") if row.spans else [])


def test_hard_texts(spark):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    compare(sorted(P.personal_data(frame).collect()), TEXTS)


def test_all_documents(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    texts = [r.text for r in documents.orderBy("doc_id").collect()]
    compare(sorted(P.personal_data(documents).collect()), texts)


def test_odd_tables(hard, empty):
    rows = P.personal_data(hard).collect()
    assert len(rows) == hard.count()
    assert P.personal_data(empty).collect() == []
    assert P.redact(empty).collect() == []
    clean = P.redact(hard)
    assert clean.columns == hard.columns
    assert sorted(map(str, (r.doc_id for r in clean.collect()))) == sorted(map(str, (r.doc_id for r in hard.collect())))
    # A text stays as it is exactly where nothing was found.
    found = Counter((r.doc_id, r.spans != "") for r in rows)
    kept = Counter((r.doc_id, r.text) for r in clean.collect())
    texts = Counter((r.doc_id, r.text) for r in hard.collect())
    same = sum((kept & texts).values())
    assert same == sum(n for (_, any_found), n in found.items() if not any_found)


def test_reliabilities_find_the_bad_labeler(spark):
    rows = [(1, 1, 1, 1, 1, 90), (-1, -1, -1, 1, -1, 90), (1, 1, 1, -1, 1, 80), (-1, -1, 1, -1, -1, 10)]
    counts = spark.createDataFrame(rows, [*P.VOTES, "n"])
    prior, fitted = P.reliabilities(counts)
    table = fitted["table"]
    assert 0.5 < prior < 0.75
    assert table["check", 1, 1] > 0.9 > 0.6 > table["words", 1, 1]


def test_loose_spans_need_the_classifier(spark):
    good = [(k, f"write to user{k}@example.com or call +1 (555) 555-{1000 + k} now") for k in range(60)]
    loose = [(100, "write to john (at) example (dot) com or call 555-123-4567 now")]
    spans = {r.doc_id: r.spans for r in P.personal_data(spark.createDataFrame(good + loose, "doc_id long, text string")).collect()}
    assert all(s.count(":") == 4 for k, s in spans.items() if k < 60)
    model = {"prior": -50.0, "weights": {}}
    frame = spark.createDataFrame(loose, "doc_id long, text string")
    none = frame.select(P.listed(P.chosen(model, P.candidates(frame.text))).alias("s")).first().s
    some = frame.select(P.listed(P.chosen({**model, "prior": 50.0}, P.candidates(frame.text))).alias("s")).first().s
    assert none == "" and some == "email:9:36,phone:45:57"


def test_redacted_text(spark):
    text = "é me@mail.example.com, 10.0.0.1! 4111 1111 1111 1111; +1 (558) 555-1788."
    frame = spark.createDataFrame([(1, text, "en", "s", len(text)), (2, "clean", "en", "s", 5), (3, None, "en", "s", None)],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    rows = sorted(P.redact(frame).collect())
    assert rows[0].text == "é <email>, <ip>! <card>; <phone>."
    assert rows[0].n_chars == len(rows[0].text)
    assert tuple(rows[1]) == (2, "clean", "en", "s", 5) and rows[2].text is None
