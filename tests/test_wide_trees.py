"""Trees grown for many rows against Spark's own fit and against plain counting."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from oncallmart.models import paths, risk, wide_trees


@pytest.fixture(scope="module")
def ready(spark):
    """No two features part the rows alike, so there are no ties for Spark to break by rounding."""
    rng = np.random.default_rng(3)
    rows = []
    for k in range(3000):
        group, kind, hour, load = f"g{rng.integers(9)}", f"k{rng.integers(4)}", int(rng.integers(24)), float(rng.normal())
        chance = 0.2 + 0.3 * (group in {"g1", "g4"}) + 0.25 * (hour > 17) * (kind != "k2") + 0.1 * (load > 0.5)
        rows.append((f"t{k}", int(rng.random() < chance), float(hour), load, group, kind))
    mart = spark.createDataFrame(rows, f"incident_id string, {risk.LABEL} int, hora double, carga double, grupo string, tipo string")
    return risk.prepare(mart)


def probabilities(model, frame):
    return {r.incident_id: r.y_pred_proba for r in risk.score(model, frame).collect()}


def test_many_rows_get_the_trees_of_sparks_fit(ready, monkeypatch):
    few = risk.fit(ready.train, trees=6, depth=4)
    monkeypatch.setattr(risk, "SPARK_ROWS", 0)
    many = risk.fit(ready.train, trees=6, depth=4)
    assert isinstance(many, paths.Model) and not isinstance(few, paths.Model)
    want, got = probabilities(few, ready.test), probabilities(many, ready.test)
    assert set(got) == set(want) and len(want) > 500
    assert max(abs(got[k] - want[k]) for k in want) < 1e-9
    names = ready.encoder.names()
    for explain in (risk.permutation_importance, risk.tree_importance):
        a, b = ({r.feature: r.importance for r in explain(m, ready.test, names).collect()} for m in (few, many))
        assert a == pytest.approx(b, abs=1e-9)
    cut = risk.select_features(ready, risk.permutation_importance(many, ready.test, names))
    again = risk.fit(cut.train, trees=3, depth=3)
    monkeypatch.setattr(risk, "SPARK_ROWS", 100_000)
    want, got = probabilities(risk.fit(cut.train, trees=3, depth=3), cut.test), probabilities(again, cut.test)
    assert max(abs(got[k] - want[k]) for k in want) < 1e-9


def test_folds_grown_together_are_those_grown_apart(ready, monkeypatch):
    want = {r.fold: (r.tickets, r.auc) for r in risk.cross_validate(ready.train, folds=3, trees=12, depth=3).collect()}
    monkeypatch.setattr(risk, "SPARK_ROWS", 0)
    # Twelve trees: the margins are stored once on the way.
    got = {r.fold: (r.tickets, r.auc) for r in risk.cross_validate(ready.train, folds=3, trees=12, depth=3).collect()}
    assert set(got) == set(want)
    for fold, (tickets, auc) in want.items():
        assert got[fold][0] == tickets and got[fold][1] == pytest.approx(auc, abs=1e-9)


def test_rows_add_up_to_the_margin(ready, monkeypatch):
    monkeypatch.setattr(risk, "SPARK_ROWS", 0)
    made = risk.tree_contributions(risk.fit(ready.train, trees=4), ready.test)
    total = F.aggregate("contributions", F.col("base"), lambda a, x: a + x)
    assert made.agg(F.max(F.abs(total - F.col("margin")))).first()[0] < 1e-9


def test_numbers_of_many_values_are_cut_at_quantiles(ready, monkeypatch):
    monkeypatch.setattr(wide_trees, "EXACT_VALUES", 1000)
    rows = ready.train.withColumn("fold", F.lit(0))
    layout = wide_trees.layout_of(rows, ready.encoder.width(), [-1])
    hours, loads = layout.ends[:2]
    assert hours == tuple(h + 0.5 for h in range(23)) and len(loads) == wide_trees.BINS - 1
    assert all(e is None for e in layout.ends[2:])
    below = np.searchsorted(sorted(r.features[1] for r in rows.select("features").collect()), loads, side="right")
    assert np.abs(np.diff([0, *below, rows.count()]) * wide_trees.BINS / rows.count() - 1).max() < 0.2


def test_rows_without_splits(spark):
    rows = [(f"t{k}", 1.0, Vectors.dense([2.0])) for k in range(40)]
    frame = spark.createDataFrame(rows, ["incident_id", "label", "features"])
    model = wide_trees.fit(frame.withColumn("fold", F.lit(0)), 2, 2)[0]
    assert model.used == [] and {r.prediction for r in model.transform(frame).collect()} == {1.0}


def test_sums_of_a_block():
    rng = np.random.default_rng(5)
    layout = wide_trees.Layout(((0.5, 1.5), None, None, (0.0,), None))
    x = np.stack([rng.integers(0, 3, 400), rng.random(400) < 0.3, rng.random(400) < 0.5, rng.normal(size=400),
                  rng.random(400) < 0.1], axis=1).astype(float)
    label, fold = np.where(rng.random(400) < 0.4, 1.0, 0.0), rng.integers(0, 2, 400)
    block = wide_trees.Block.of(x, label, fold, layout, 1)
    tree = wide_trees.Tree.empty(2)
    tree.feature[0], tree.feature[1] = 1, 0
    at = block.at(tree, layout, 2)
    assert (at == np.where(x[:, 1] > 0, 2, np.where(x[:, 0] <= 0.5, 3, 4))).all()
    sums = wide_trees.sums(block.tables(0, 1, tree, 1, layout, True), layout)
    for node, inside in ((0, x[:, 1] == 0), (1, x[:, 1] == 1)):
        kept = inside & (fold != 1)
        assert sums[1, node].tolist() == [
            *[int((kept & (x[:, 0] == v)).sum()) for v in range(3)], int((kept & (x[:, 1] > 0)).sum()),
            int((kept & (x[:, 2] > 0)).sum()), int((kept & (x[:, 3] <= 0)).sum()), int((kept & (x[:, 3] > 0)).sum()),
            int((kept & (x[:, 4] > 0)).sum()), int(kept.sum()),
        ]
        assert sums[0, node, -1] == (2 * label - 1)[kept].sum() * wide_trees.SCALE
