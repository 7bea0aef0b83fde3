"""Operators against brute force on small data, including very uneven keys."""

from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from oncallmart.operators import analytics, evaluation, joins, ordered, prep, quality, series


@pytest.fixture(scope="module")
def uneven(spark):
    """A third of the rows share one key and one value; some keys are null."""
    rng = np.random.default_rng(5)
    n = 3000
    key = np.where(rng.random(n) < 0.34, "hot", rng.integers(0, 40, n).astype(str))
    value = np.where(rng.random(n) < 0.34, 7.0, np.round(rng.normal(0, 50, n), 2))
    frame = pd.DataFrame({"id": [f"r{i}" for i in range(n)], "key": key, "value": value})
    frame.loc[::50, "key"] = None
    frame["label"] = (rng.random(n) < 0.3).astype(int)
    return frame, spark.createDataFrame(frame).cache()


def test_quantiles_match_numpy(uneven):
    local, frame = uneven
    points = {"p05": 0.05, "p25": 0.25, "p50": 0.5, "p99": 0.99}
    got = ordered.quantiles(frame, ["value"], points).first()
    for name, p in points.items():
        assert got[name] == pytest.approx(np.quantile(local["value"], p))


def test_grouped_quantiles_keep_the_null_group(uneven):
    local, frame = uneven
    got = ordered.quantiles(frame, ["value"], {"q": 0.75}, ["key"]).toPandas()
    found = {None if pd.isna(k) else k: v for k, v in zip(got["key"], got["q"])}
    expected = {
        (None if pd.isna(k) else k): np.quantile(g["value"], 0.75)
        for k, g in local.groupby("key", dropna=False)
    }
    assert found == pytest.approx(expected)


@pytest.mark.parametrize("levels", [1, 4, 9])
def test_running_sums_do_not_depend_on_the_cuts(uneven, levels):
    local, frame = uneven
    counts = frame.groupBy("value").agg(F.count("*").alias("n"))
    got = ordered.running_sums(counts, "value", ["n"], levels=levels).orderBy("value").toPandas()
    expected = local["value"].value_counts().sort_index()
    assert got["n_before"].tolist() == (expected.cumsum() - expected).tolist()
    assert set(got["n_total"]) == {len(local)}


def test_auc_matches_pairs(uneven):
    local, frame = uneven
    got = evaluation.auc(frame, "label", "value").first()["auc"]
    pos = local.loc[local["label"] == 1, "value"].to_numpy()[:, None]
    neg = local.loc[local["label"] == 0, "value"].to_numpy()[None, :]
    assert got == pytest.approx(((pos > neg) + 0.5 * (pos == neg)).mean(), abs=1e-9)


def test_auc_matches_the_spark_evaluator(uneven):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    _, frame = uneven
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol="value", labelCol="label", numBins=0
    )
    got = evaluation.auc(frame, "label", "value").first()["auc"]
    assert got == pytest.approx(evaluator.evaluate(frame), abs=1e-6)


def test_pr_curve_matches_counting(uneven):
    local, frame = uneven
    curve = evaluation.pr_curve(frame, "label", "value").toPandas()
    for row in curve.sample(25, random_state=1).itertuples():
        flagged = local[local["value"] >= row.threshold]
        assert (row.tp, row.fp) == (flagged["label"].sum(), (1 - flagged["label"]).sum())
    best = evaluation.best_threshold(evaluation.pr_curve(frame, "label", "value")).first()
    assert best["f1"] == pytest.approx(curve["f1"].max())


def test_null_safe_join(spark):
    left = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    right = spark.createDataFrame([("a", 10), (None, 20)], "k string, w int")
    got = sorted(tuple(r) for r in joins.null_safe_join(left, right, ["k"]).select("v", "w").collect())
    assert got == [(1, 10), (2, 20)]


def test_orphans_count_rows(spark):
    child = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("a",)], "k string")
    assert [tuple(r) for r in joins.orphans(child, parent, "k").collect()] == [("b", 2)]


def test_exact_split_quota_and_stability(uneven):
    _, frame = uneven
    split = prep.exact_stratified_split(frame, "label", "id")
    again = prep.exact_stratified_split(frame.repartition(3), "label", "id")
    sizes = split.groupBy("label").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t"))
    for row in sizes.collect():
        assert row["t"] == round(row["n"] * 0.2)
    assert split.join(again.select("id", F.col("is_test").alias("b")), "id").where(
        "is_test <> b").count() == 0


def test_folds_are_even_in_each_class(uneven):
    _, frame = uneven
    folds = prep.stratified_folds(frame, "label", 5, "id")
    sizes = folds.groupBy("label", "fold").count().toPandas()
    assert folds.count() == frame.count()
    spans = sizes.groupby("label")["count"].agg(lambda c: c.max() - c.min())
    assert (spans <= 1).all() and set(sizes["fold"]) == set(range(5))


def test_one_hot_levels_cap(spark):
    rows = [(f"l{i:03d}",) for i in range(60) for _ in range(60 - i)]
    frame = spark.createDataFrame(rows, "c string")
    kept = [r["level"] for r in prep.one_hot_levels(frame, ["c"], 50).collect()]
    assert len(kept) == 49 and "l000" in kept and "l049" not in kept


def test_iqr_votes_ignore_nulls(spark):
    frame = spark.createDataFrame(
        [(str(i), float(i % 10), None) for i in range(99)] + [("x", 1000.0, None)],
        "id string, a double, b double",
    )
    fences = prep.iqr_fences(frame, ["a"])
    voted = prep.iqr_votes(frame, {**fences, "b": (0.0, 1.0)}, share=0.4)
    clean, outliers = prep.split_outliers(voted)
    assert [r["id"] for r in outliers.collect()] == ["x"] and clean.count() == 99


def test_histogram_matches_numpy(uneven):
    local, frame = uneven
    got = analytics.histogram(frame, "value", 30).orderBy("bin").toPandas()
    counts = np.zeros(30, int)
    counts[got["bin"]] = got["tickets"]
    assert counts.sum() == len(local)
    assert np.abs(counts - np.histogram(local["value"], 30)[0]).max() <= 1


def test_constant_column_histogram_and_scaling(spark):
    frame = spark.createDataFrame([(1.0,), (1.0,)], "v double")
    assert [tuple(r) for r in analytics.histogram(frame, "v", 5).collect()] == [(2, 2)]
    assert {r["v"] for r in prep.standardise(frame, ["v"]).collect()} == {0.0}


def test_hot_keys_keep_every_row(spark, tmp_path):
    """A third of the tickets share one parent, one group, one second and one product."""
    from oncallmart import schema as S
    from oncallmart.operators import silver, star

    n = 3000
    hot = F.col("id") % 3 == 0
    number = F.concat(F.lit("INC"), F.lpad(F.col("id").cast("string"), 9, "0"))
    start = F.lit("2025-01-06 09:00:00").cast("timestamp_ntz")
    tickets = spark.range(n).select(
        number.alias("Numero"), F.lit("2 - Alta").alias("Prioridade"),
        F.when(hot, "P").otherwise(F.concat(F.lit("P"), F.col("id"))).alias("Produto"),
        F.lit("C").alias("Categoria"), F.lit("S").alias("Subcategoria"),
        F.when(~hot, F.concat(F.lit("T"), F.col("id") % 50)).alias("Grupo_designado"),
        F.lit("CI").alias("Item_de_configuracao"),
        F.when(hot, start).otherwise(
            start + F.make_dt_interval(secs=F.col("id").cast("decimal(18,6)"))
        ).alias("Aberto"),
        start.alias("Resolvido"), start.alias("Encerrado"), F.col("id").alias("Duracao"),
        F.lit("Sucesso").alias("Codigo_de_fechamento"), F.lit("d").alias("Descricao_resumida"),
        F.lit("s").alias("Solucao"), F.lit("u").alias("Aberto_por"),
        F.when(hot, F.lit("INC000000001")).alias("Incidente_Pai"),
        F.lit("Encerrado").alias("Status"), F.lit("SIM").alias("Entrou_para_KPI"),
        F.lit("NAO").alias("KPI_Violado"),
    )
    made = silver.silver(tickets)
    assert made.columns[: len(S.BRONZE.names)] == S.BRONZE.names
    joined = star.star_join(star.fact(made), star.dimensions(made))
    assert joined.count() == n and joined.select("incident_id").distinct().count() == n
    assert joined.where("grupo_designado is null").count() == n // 3
    children = analytics.parent_children(made).collect()
    assert [(r["parent_id"], r["children"]) for r in children] == [("INC000000001", n // 3)]
    quartiles = ordered.quantiles(made, ["Duracao_Horas"], {"q": 0.5}, ["Grupo_designado"])
    assert quartiles.count() == 51
    split = prep.exact_stratified_split(made, "Possui_Pai", "Numero")
    assert split.count() == n and split.where("is_test").count() == n // 5


# --- Series ----------------------------------------------------------------------------


def days(spark, team, count, skip=()):
    first = date(2024, 1, 1)
    rows = [(team, first + timedelta(i), i % 7 + 1) for i in range(count) if i not in skip]
    return spark.createDataFrame(rows, "team string, ds date, y bigint")


def test_gaps_are_filled_with_zero(spark):
    filled = series.fill_days(days(spark, "t", 20, skip={3, 4}))
    assert filled.count() == 20
    assert [r["y"] for r in filled.orderBy("ds").collect()][3:5] == [0, 0]


@pytest.mark.parametrize("count, kept", [(59, 0), (60, 60)])
def test_short_series_are_left_out(spark, count, kept):
    assert series.long_enough(days(spark, "t", count)).count() == kept


def test_folds_never_look_past_the_cutoff(spark):
    from oncallmart.models import forecast

    made = forecast.rolling_origin(days(spark, "t", 200)).toPandas()
    assert (made["ds"] > made["cutoff"]).all()
    assert made["horizon"].between(1, 7).all()
    # The pattern repeats every week, so a weekly model foresees it.
    assert np.abs(made["y"] - made["yhat"]).max() < 1e-3
    folds = series.cutoffs(days(spark, "t", 200), "team").toPandas()
    assert set(made["cutoff"]) == set(folds["cutoff"])


def test_group_forecast_continues_the_pattern(spark):
    from oncallmart.models import forecast

    both = days(spark, "a", 84).unionByName(days(spark, "b", 70)).unionByName(days(spark, "c", 9))
    held = forecast.group_errors(forecast.holdout_by_group(both)).toPandas()
    assert set(held["team"]) == {"a", "b"} and held["mape"].max() < 1e-6
    ahead = forecast.forecast_groups(both).toPandas()
    assert ahead.groupby("team").size().to_dict() == {"a": 7, "b": 7}
    assert np.allclose(ahead.sort_values(["team", "ds"])["yhat"], [1, 2, 3, 4, 5, 6, 7] * 2)


# --- Quality -----------------------------------------------------------------------------


def test_schema_check_names_what_is_wrong(spark):
    from oncallmart import schema as S

    frame = spark.createDataFrame([("a", 1)], "Numero string, Duracao int")
    with pytest.raises(quality.CheckFailed, match="Prioridade.*Duracao: int instead of bigint"):
        quality.require_schema(frame, S.BRONZE, S.REQUIRED)
    assert quality.column_differences(frame, ["Numero", "X"]) == (["X"], ["Duracao"])


def test_empty_table_fails(spark):
    with pytest.raises(quality.CheckFailed):
        quality.require_rows(spark.createDataFrame([], "a int"))


def test_rules_count_violations(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 9), (None, None)], "k string, v int")
    got = quality.union(
        [
            quality.unique("t", frame, "k"),
            quality.row_rules(
                "t", frame,
                [quality.not_null("k"), quality.accepted("v", [1, 2]), quality.in_range("v", 0, 5)],
            ),
        ]
    )
    assert {(r["column"], r["rule"]): r["violations"] for r in got.collect()} == {
        ("k", "unique"): 1, ("k", "not_null"): 1, ("v", "accepted_values"): 1, ("v", "range"): 1,
    }
