"""Every stage of the pipeline against a brute-force version, on what the one before kept."""

import re
from collections import defaultdict

import test_decontaminate
import test_near_dedup
import test_packing
import test_personal

import corpus_pipeline
from oncallmart.llm import quality


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    columns = docs.columns
    good = {r.doc_id for r in quality.score_documents(docs, labels).collect() if r.predicted}
    stages = dict(corpus_pipeline.STAGES)

    kept = stages["quality classifier"](spark, docs, small)
    rows = [tuple(r) for r in kept.collect()]
    assert kept.columns == columns and {r[0] for r in rows} == good and 0 < len(good) < docs.count()

    kept = stages["near duplicates"](spark, spark.createDataFrame(rows, docs.schema), small)
    stay = {i for i, _, _, k in test_near_dedup.brute([r[:2] for r in rows]) if k}
    assert kept.columns == columns and sorted(map(tuple, kept.collect())) == sorted(r for r in rows if r[0] in stay)
    rows = [r for r in rows if r[0] in stay]

    kept = stages["benchmark decontamination"](spark, spark.createDataFrame(rows, docs.schema), small)
    leaked = {d for d, *_ in test_decontaminate.brute([r[:2] for r in rows], items)}
    assert leaked and kept.columns == columns
    rows = [r for r in rows if r[0] not in leaked]
    assert sorted(map(tuple, kept.collect())) == sorted(rows)

    kept = stages["personal data"](spark, spark.createDataFrame(rows, docs.schema), small)
    found = {r.doc_id: r for r in kept.collect()}
    assert kept.columns == columns and found.keys() == {r[0] for r in rows}
    changed = 0
    for doc_id, text, lang, source, n_chars in rows:
        spans = [s for v in test_personal.brute(text).values() for s in v]
        got = found[doc_id]
        assert (got.lang, got.source, got.n_chars) == (lang, source, len(got.text))
        assert spans or got.text == text
        assert not any(test_personal.brute(got.text).values())
        changed += got.text != text
        plain = re.sub("<(email|ip|card|phone)>", "", got.text)
        assert len(plain) <= len(text) and bool(spans) == (got.text != text)
    assert changed


def test_run_packs_what_is_left(spark, small):
    rows = corpus_pipeline.run(spark, small).collect()
    folder = spark.read.parquet(f"{small}/documents.parquet")
    assert rows and {r.doc_id for r in rows} < {r.doc_id for r in folder.collect()}
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(sequences) <= -(-sum(r.length for r in rows) // 4096) + 1


def test_hard_and_empty_documents(spark, hard, empty, small):
    plain = ["doc_id", "text", "lang", "source", "n_chars"]
    for docs in (hard.select(*plain), empty.select(*plain)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, small)
            assert docs.columns == plain, name
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, small)
        texts = [(r.doc_id, r.text) for r in docs.collect()]
        test_packing.check(packed.collect(), texts)


def test_near_duplicates_keeps_null_ids_and_one_row_of_an_id(spark, hard, small):
    docs = hard.select("doc_id", "text", "lang", "source", "n_chars")
    rows = dict(corpus_pipeline.STAGES)["near duplicates"](spark, docs, small).collect()
    ids = [r.doc_id for r in rows]
    assert ids.count(None) == 1 and ids.count(5) == 1 and ids.count(6) == 0
