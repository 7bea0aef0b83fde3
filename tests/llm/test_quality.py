import random
import zlib

import numpy as np

from oncallmart.llm import quality as Q


def test_held_out_accuracy(spark, small):
    documents, labels = (spark.read.parquet(f"{small.replace('0.001', '0.1')}/{t}.parquet") for t in ("documents", "labels"))
    marked = {r.doc_id: r.quality for r in labels.collect()}
    rows = [r for r in Q.score_documents(documents, labels).collect()]
    assert len(rows) == documents.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in marked]
    assert sum(r.predicted == marked[r.doc_id] for r in held) / len(held) > 0.97


def test_walk_equals_rules():
    """The array walk of a batch equals following one row from node to node."""
    dice = np.random.default_rng(2)
    x = dice.normal(size=(800, len(Q.STATISTICS)))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    model = Q.fit(x, y)
    assert ((model.score(x) >= 0.5) == y).mean() > 0.95

    def one(row):
        total = model.base
        for statistic, cut, leaf in zip(model.statistic, model.cut, model.leaf):
            node = 0
            for _ in range(Q.DEPTH):
                node = 2 * node + (2 if row[statistic[node]] > cut[node] else 1)
            total += leaf[node - (2**Q.DEPTH - 1)]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(model.score(x[:50]), [one(r) for r in x[:50]])


def test_labels_and_held_out_rows_are_no_input(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    one = {r.doc_id: r.score for r in Q.score_documents(documents, labels).collect()}
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 3 = 1, 1 - quality, quality) as quality")
    two = {r.doc_id: r.score for r in Q.score_documents(documents.drop("lang", "source"), flipped).collect()}
    assert one == two


def test_hard_rows(spark, hard, empty):
    labels = spark.createDataFrame([(0, 1, 5), (0, 0, 5), (3, None, 5), (None, 1, 5), (4, 1, 5), (5, 0, 5)], "doc_id long, quality int, text int")
    rows = Q.score_documents(hard, labels).collect()
    assert len(rows) == hard.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in Q.score_documents(hard, labels.limit(0)).collect()} == {0.5}
    assert Q.score_documents(empty, labels).collect() == []
    assert Q.keep_good(hard, labels.limit(0)).columns == hard.columns
    assert Q.keep_good(hard, labels.limit(0)).count() == hard.count()


def test_fit_has_a_bound(spark):
    dice = random.Random(1)
    rows = [(k, " ".join(dice.choice(("a", "bb", "ccc")) for _ in range(30))) for k in range(400)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k, _ in rows], "doc_id long, quality int")
    assert isinstance(Q.train(documents, labels, fit_rows=50), Q.Model)
    assert Q.statistics(None) == Q.statistics(b"") == [0.0] * len(Q.STATISTICS)
