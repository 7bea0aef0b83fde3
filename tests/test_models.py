"""Model jobs on the smallest data: shapes, guards, and answers that are known."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from oncallmart import schema as S
from oncallmart.models import anomalies, clusters, records, risk
from oncallmart.operators import analytics, prep
from oncallmart.plans import marts


@pytest.fixture(scope="module")
def ready(base):
    return risk.prepare(marts.sla_mart(base))


@pytest.fixture(scope="module")
def model(ready):
    return risk.fit(ready.train, trees=5)


def names_of(ready):
    return [r["feature"] for r in ready.encoder.names().orderBy("pos").collect()]


def test_outcome_columns_are_refused(base):
    with pytest.raises(risk.Leak):
        risk.feature_columns(marts.sla_mart(base), ["prioridade_num", "duracao_horas"])
    numbers, texts = risk.feature_columns(marts.sla_mart(base))
    assert not set(numbers + texts) & set(S.RISK_LEAKS)


def test_split_is_disjoint_and_whole(ready, base):
    assert ready.train.join(ready.test, "incident_id").count() == 0
    assert ready.train.count() + ready.test.count() == base.count()


def test_encoder_knows_only_training_levels(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "grupo string, x double")
    encoder = risk.fit_encoder(train, ["grupo", "x"])
    test = spark.createDataFrame([("new", 1.0), (None, None)], "grupo string, x double")
    vectors = [r["features"].toArray() for r in encoder.apply(test).collect()]
    assert encoder.names().count() == encoder.width() == len(vectors[0])
    assert sum(v[1:].sum() for v in vectors) <= 2 and {v[0] for v in vectors} == {0.0, 1.0}


def test_every_level_has_its_own_place(spark):
    train = spark.range(3000).select(F.concat(F.lit("g"), F.col("id") % 1500).alias("grupo"))
    encoder = risk.fit_encoder(train, ["grupo"])
    names = [r["feature"] for r in encoder.names().orderBy("pos").collect()]
    assert len(names) == len(set(names)) == encoder.width() == 1501
    sums = np.sum([r["features"].toArray() for r in encoder.apply(train.limit(200)).collect()], axis=0)
    assert sums[-1] == 0 and sums.sum() == 200


def test_scores_separate_the_classes(model, ready):
    scores = risk.score(model, ready.test)
    assert scores.columns == ["incident_id", "y_real", "y_pred", "y_pred_proba"]
    assert risk.auc_of(scores) > 0.6
    assert risk.alerts(scores).where("y_pred_proba <= 0.8").count() == 0


def test_importance_ranks_priority_first(model, ready):
    ranking = risk.permutation_importance(model, ready.test, ready.encoder.names())
    assert ranking.count() == ready.encoder.width()
    assert ranking.orderBy(F.desc("importance")).first()["feature"] == "prioridade_num"
    assert risk.linear_shap(ready).orderBy(F.desc("importance")).first()["feature"] == "prioridade_num"


def test_permutation_importance_against_brute_force(model, ready):
    """The same ring of donors, swapped one feature at a time in plain numpy."""
    names = names_of(ready)
    got = {
        r["feature"]: r["importance"]
        for r in risk.permutation_importance(model, ready.test, ready.encoder.names()).collect()
    }
    rows = ready.test.select(
        "incident_id", "features", F.xxhash64("incident_id", F.lit(7)).alias("o")
    ).toPandas().sort_values(["o", "incident_id"])
    x = np.stack([v.toArray() for v in rows["features"]])
    position = names.index("prioridade_num")
    swapped = x.copy()
    swapped[:, position] = np.roll(x[:, position], -1)
    from pyspark.ml.linalg import Vectors

    def probabilities(matrix):
        return np.array([model.predictProbability(Vectors.dense(r))[1] for r in matrix])

    expected = np.abs(probabilities(swapped) - probabilities(x)).mean()
    assert got["prioridade_num"] == pytest.approx(expected, abs=1e-9)


def test_selection_keeps_the_named_features(spark, ready):
    names = names_of(ready)
    ranking = spark.createDataFrame(
        [(n, 1.0 if n == "prioridade_num" else 0.0) for n in names], "feature string, importance double"
    )
    cut = risk.select_features(ready, ranking)
    assert cut.train.first()["features"].size == 1


def test_grid_and_folds(ready):
    small = {"maxDepth": [2, 3], "stepSize": [0.1], "maxIter": [2, 4]}
    results = risk.grid_search(ready, small)
    assert results.count() == 4
    heat = analytics.pivot_max(results, "max_depth", "learning_rate", "auc_roc", [0.1])
    assert heat.count() == 2 and heat.where("`0.1` is null").count() == 0
    best = risk.best_of_grid(results).first()
    assert best["auc_roc"] == results.agg(F.max("auc_roc")).first()[0]
    folds = risk.cross_validate(ready.train, folds=3, trees=2, depth=2)
    assert folds.count() == 3 and folds.agg(F.sum("tickets")).first()[0] == ready.train.count()
    assert 0.5 < risk.cv_summary(folds).first()["cv_auc_mean"] <= 1


def test_class_weights_balance(ready):
    weighted = risk.with_class_weights(ready.train)
    sums = [r[1] for r in weighted.groupBy("label").agg(F.sum("weight")).collect()]
    assert sums[0] == pytest.approx(sums[1])


def test_clusters_cover_every_ticket(base):
    made = clusters.run(marts.cluster_mart(base), restarts=2)
    assert made.assignments.count() == base.count()
    sizes = made.assignments.groupBy("cluster_label").count().orderBy("cluster_label").collect()
    assert [r[0] for r in sizes] == ["A", "B", "C", "D"]
    counts = [r[1] for r in sizes]
    assert counts == sorted(counts, reverse=True)
    assert made.features.explained >= clusters.VARIANCE
    quality = {r["metric"]: r["value"] for r in clusters.quality(made).collect()}
    assert -1 <= quality["silhouette_score"] <= 1 and quality["davies_bouldin_index"] > 0
    assert clusters.projection(made).where("pc1 is null or pc2 is null").count() == 0


def test_outliers_are_assigned_too(base, monkeypatch):
    mart = marts.cluster_mart(base)
    votes = prep.iqr_votes
    monkeypatch.setattr(prep, "iqr_votes", lambda frame, fences: votes(frame, fences, share=0.15))
    made = clusters.run(mart, restarts=1)
    assert made.outlier_rows > 0
    assert made.assignments.where("cluster_label is null").count() == 0
    assert made.assignments.count() == base.count()


def test_known_clusters_and_costs(spark):
    from pyspark.ml.linalg import Vectors

    rows = [(f"i{c}{j}", Vectors.dense([c * 10.0 + j * 0.01, c * 5.0])) for c in range(4)
            for j in range(10 + c)]
    points = spark.createDataFrame(rows, ["incident_id", "features"])
    model = clusters.fit_kmeans(points, restarts=5)
    labelled = clusters.label_by_size(model.transform(points))
    sizes = dict(tuple(r) for r in labelled.groupBy("cluster_label").count().collect())
    assert sizes == {"A": 13, "B": 12, "C": 11, "D": 10}
    assert clusters.silhouette(model.transform(points)) > 0.95
    assert clusters.davies_bouldin(model, model.transform(points)) < 0.05
    costs = [r["cost"] for r in clusters.sweep(points, range(2, 5)).orderBy("k").collect()]
    assert costs[0] > costs[1] > costs[2]


def test_isolated_rows_are_found(spark):
    rng = np.random.default_rng(1)
    values = rng.normal(0, 1, (1000, 2))
    values[:20] += 12
    frame = spark.createDataFrame(
        pd.DataFrame({"incident_id": [f"i{i:04d}" for i in range(1000)],
                      "a": values[:, 0], "b": values[:, 1]})
    )
    found = anomalies.detect(frame, 0.02, ["a", "b"]).where("anomaly = -1").toPandas()
    assert len(found) == 20
    assert (found["incident_id"] < "i0020").mean() > 0.9


def test_open_tickets_are_scored(spark):
    frame = spark.range(400).select(
        F.concat(F.lit("i"), F.col("id")).alias("incident_id"), F.rand(3).alias("a"),
        F.when(F.col("id") % 4 > 0, F.rand(4)).alias("b"),
    )
    found = anomalies.detect(frame, 0.05, ["a", "b"])
    assert found.count() == 400 and found.where("anomaly_score is null").count() == 0


def test_draw_stays_thin_on_many_rows(spark):
    points = spark.range(400_000).select(F.col("id").cast("string").alias("incident_id"), F.array(F.lit(1.0)).alias("x"))
    drawn = anomalies.samples(points, 400_000, trees=4, size=32)
    assert [r["count"] for r in drawn.groupBy("tree").count().collect()] == [32] * 4
    assert drawn.select("incident_id").distinct().count() == 128


def test_samples_have_the_asked_size(spark):
    points = spark.range(5000).select(
        F.concat(F.lit("i"), F.col("id")).alias("incident_id"), F.array(F.rand(1)).alias("x")
    )
    sizes = anomalies.samples(points, 5000, trees=10).groupBy("tree").count().collect()
    assert [r["count"] for r in sizes] == [256] * 10


def test_latest_record_wins(spark):
    def rows(run, value, at):
        return records.record(risk.metric_rows(spark, {"mape": value}), run, "forecast_d1", at)

    both = rows("r1", 0.5, "2026-01-01 05:00:00").unionByName(rows("r2", 0.4, "2026-01-02 05:00:00"))
    assert records.latest(both).first()["value"] == 0.4
    moved = records.changes(both).where("previous is not null").first()
    assert moved["run_id"] == "r2" and moved["change"] == pytest.approx(-0.2)


def test_parts_that_a_fit_keeps_are_bounded(ready, monkeypatch):
    """Rows of few files, which the fits would cache as a few large parts."""
    rows = ready.train.coalesce(1)
    assert risk.spread(rows) is rows
    width, n = rows.first()["features"].size, rows.count()
    monkeypatch.setattr(risk, "TASK_CELLS", n * width // 20)
    parts = risk.spread(rows).rdd.glom().map(len).collect()
    assert sum(parts) == n and max(parts) <= 2 * n / 20


def test_tickets_are_stored_before_the_fences_read_them(base, monkeypatch):
    """The fences must not join the tickets apart from the rows that they are then applied to."""
    read, fences = [], prep.iqr_fences

    def seen(frame, *columns):
        read.append(frame.inputFiles())
        return fences(frame, *columns)

    monkeypatch.setattr(prep, "iqr_fences", seen)
    mart = marts.cluster_mart(base)
    clusters.run(mart, restarts=1)
    assert len(read) == 1 and read[0] and not set(read[0]) & set(mart.inputFiles())


def test_runs_pass_over_blocks_and_cost_the_same(spark, monkeypatch):
    """Left to choose, Spark measures every row of dense points alone. Both ways end with the same
    costs, nulls and copies among the rows or not."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.linalg import Vectors

    dice = np.random.default_rng(5)
    rows = [(f"i{k}", Vectors.dense(dice.normal(k % 3 * 4, 1, 5).tolist())) for k in range(300)]
    points = spark.createDataFrame([*rows, *rows[:50], (None, rows[0][1])], ["incident_id", "features"])
    fitted, fit_all = [], clusters._fit_all
    monkeypatch.setattr(clusters, "_fit_all", lambda runs, frame: fitted.extend(runs) or fit_all(runs, frame))
    costs = [r["cost"] for r in clusters.sweep(points, range(2, 6)).orderBy("k").collect()]
    best = clusters.fit_kmeans(points, k=3, restarts=2).summary.trainingCost
    assert {run.getSolver() for run in fitted} == {"block"} and len(fitted) == 6
    plain = [KMeans(k=k, maxIter=300, seed=42, solver="row").fit(points).summary.trainingCost for k in range(2, 6)]
    assert costs == pytest.approx(plain)
    restarts = [KMeans(k=3, maxIter=300, seed=42 + i, solver="row").fit(points).summary.trainingCost for i in range(2)]
    assert best == pytest.approx(min(restarts))
