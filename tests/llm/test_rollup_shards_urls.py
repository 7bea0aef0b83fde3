import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from oncallmart.llm import rollup, sharding
from oncallmart.llm import url_filter as U


@pytest.fixture
def store(spark, tmp_path):
    return rollup.Store(spark, str(tmp_path / "rollup"))


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "source string, lang string, tokenizer string, tokens long")


def test_batches_apply_once_in_any_order(spark, store):
    a = rows_of(spark, [("s", "en", "v1", 5), ("s", "en", "v1", 7), (None, None, "v1", 1)])
    new = rows_of(spark, [("s", "en", "v2", 6)])
    old = rows_of(spark, [("s", "en", "v1", 5)])
    assert store.commit("2", rollup.revise(old, new))
    assert store.commit("1", rollup.insert(a))
    assert not store.commit("1", rollup.insert(a))
    assert not store.commit("1", rollup.delete(a))
    want = {("s", "en", "v1", 1, 7), ("s", "en", "v2", 1, 6), (None, None, "v1", 1, 1)}
    assert {tuple(r) for r in store.totals(["1", "2", "3"]).collect()} == want
    assert store.commit("3", rollup.delete(rows_of(spark, [(None, None, "v1", 1)])))
    assert (None, None, "v1", 0, 0) in {tuple(r) for r in store.totals(["1", "2", "3"]).collect()}


def test_torn_batch_is_written_anew(spark, store, tmp_path):
    torn = tmp_path / "rollup" / "batch=1"
    rollup.insert(rows_of(spark, [("s", "en", "v1", 5)])).groupBy(*rollup.KEYS).count().write.parquet(str(torn))
    (torn / "_SUCCESS").unlink()
    assert not store.committed("1") and store.totals(["1"]).collect() == []
    assert store.commit("1", rollup.insert(rows_of(spark, [("s", "en", "v1", 9)])))
    assert [tuple(r) for r in store.totals(["1"]).collect()] == [("s", "en", "v1", 1, 9)]


def test_empty_batch(spark, store):
    assert store.commit("1", rollup.insert(rows_of(spark, [])))
    assert store.totals(["1"]).collect() == []


def test_rollup_of_hard_rows(hard, empty):
    rows = [tuple(r) for r in rollup.document_rollup(hard).collect()]
    known = [(r.doc_id, r.text or "") for r in hard.collect()]
    first = {}
    for i, t in known:
        first[t] = min(first.get(t, i), i) if i is not None and first.get(t, i) is not None else first.get(t)
    stay = sum(i is None or first[t] is None or i <= first[t] for i, t in known)
    assert sum(docs for *_, docs, _ in rows) == stay
    assert rollup.document_rollup(empty).collect() == []


def jump(key, shards):
    """The published loop."""
    at, ahead = -1, 0
    while ahead < shards:
        at = ahead
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        ahead = int((at + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return at


def test_jump_hash():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 3000, dtype=np.uint64)
    for shards in (1, 2, 24, 25, 1000):
        assert sharding.jump(keys, shards).tolist() == [jump(int(k), shards) for k in keys]
    a, b = sharding.jump(keys, 24), sharding.jump(keys, 25)
    assert set(b[a != b].tolist()) == {24} and 0.02 < (a != b).mean() < 0.06


def check_shards(frame, rows):
    got = frame.collect()
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    slots, places = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        places[r.doc_id].add((r.shard, r.grown_shard))
        assert r.law == "key" and r.grown_shard in (r.shard, 24) and 0 <= r.shard < 24
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(p) == 1 for p in places.values())


def test_shards(spark, small, hard, empty):
    documents = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    check_shards(sharding.assign(documents, block_rows=3), [tuple(r) for r in documents.collect()])
    check_shards(sharding.assign(hard), [(r.doc_id, r.text) for r in hard.collect()])
    assert sharding.assign(empty).collect() == []
    copies = spark.createDataFrame([(7, "same")] * 500, "doc_id long, text string")
    check_shards(sharding.assign(copies, block_rows=10), [(7, "same")] * 500)


def test_written_shards(spark, small, tmp_path):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    sharding.write_shards(documents, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    want = {r.doc_id: r.shard for r in sharding.assign(documents).collect()}
    assert {r.doc_id: r.shard for r in back.select("doc_id", "shard").collect()} == want


URLS = [
    None, "", "no scheme.net/", "http://net/", "http://a.NET", "http://a.net/x", "x://a.b.example.net/en/1?q", "http://example.net/EN/",
    "http://notexample.net/en/", "http://a.net:80/", "http://u@example.com/de/?", "http://example.com/de", "http://x.org/fr/#a",
    "http://x.org?/fr/", "http:///net/", "a://b://c.net/", "http://spam-farm.example.org/fr/", "http://www.spam-farm.example.org/en/1",
    "http://x.org\n.net/ y", "http://é.net/ñ", "http://example.net/en/" + "x" * 50000, "http://K.org/\u212a",
]


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut : min([rest.find(c) for c in "?#" if c in rest], default=len(rest))] if cut < len(rest) else ""
    best = None
    for rule, verdict in U.HOST_RULES:
        own, slash, tail = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith(slash + tail):
            if best is None or len(rule) > len(best[0]):
                best = (rule, verdict)
    spam = host.startswith("spam-farm.") or ".spam-farm." in host
    return (host, path, *(best or (None, "block" if spam else "allow")))


def test_verdicts(spark):
    rows = list(enumerate(URLS)) + [(5, URLS[5]), (None, URLS[6])]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' as host", "1 as rule")
    got = sorted(map(str, map(tuple, U.judge(pages).collect())))
    assert got == sorted(str((i, *brute(u))) for i, u in rows)
    assert U.judge(pages.limit(0)).collect() == []
    assert {r.verdict for r in U.judge(pages, rules=[]).collect()} == {"allow"}


def test_rules_stand_under_their_rarest_token(spark):
    tokens = spark.createDataFrame([("net",), ("net",), ("example",), ("en",), ("en",), ("en",)], "token string")
    rules = spark.createDataFrame(U.host_rules([("example.net/en/", "allow"), ("net/", "block"), ("org/fr/", "allow")]), U.RULE)
    index = {r.rule: r.token for r in U.index_rules(tokens, rules).collect()}
    assert index == {"example.net/en/": "example", "net/": "net"}
