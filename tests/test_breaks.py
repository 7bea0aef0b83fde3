"""Planted changes of trend, the penalised fit's conditions, intervals, and the backtest."""

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from oncallmart.models import breaks


def planted(changes, n=900, noise=3.0, seed=0):
    rng = np.random.default_rng(seed)
    days = np.arange(10_000, 10_000 + n)
    y = 50 + 0.02 * (days - days[0]) + 4 * np.sin(2 * np.pi * days / 7)
    for at, slope in changes:
        y = y + slope * np.maximum(days - days[0] - at, 0)
    return days, y + rng.normal(0, noise, n)


@pytest.mark.parametrize("changes", [[(400, 0.15)], [(250, 0.2), (600, -0.3)], [(200, -0.15), (450, 0.25), (700, -0.2)]])
def test_planted_changes_are_found_within_a_week(changes):
    days, y = planted(changes)
    made = breaks.fit(days, y)
    assert len(made.changes) == len(changes)
    for (at, slope), found, size in zip(changes, made.changes - days[0], made.slopes):
        assert abs(found - at) <= 7 and size / 365.25 == pytest.approx(slope, rel=0.15)


def test_a_straight_series_has_no_change():
    for seed in range(5):
        days, y = planted([], seed=seed)
        made = breaks.fit(days, y)
        assert len(made.changes) == 0 and made.size == 0
        np.testing.assert_allclose(made.predict(days.astype(float)), breaks.fit(days, y, bends=False).predict(days.astype(float)))


def test_coordinate_descent_meets_its_conditions():
    rng = np.random.default_rng(3)
    c = rng.normal(size=(80, 30))
    c /= np.sqrt((c**2).sum(axis=0))
    y = c[:, 3] * 4 - c[:, 17] * 3 + rng.normal(0, 0.1, 80)
    x = breaks.lasso(c.T @ c, c.T @ y, 0.3, np.zeros(30), 2000)
    slope = c.T @ (y - c @ x)
    assert np.abs(slope).max() <= 0.3 + 1e-4
    np.testing.assert_allclose(slope[x != 0], 0.3 * np.sign(x[x != 0]), atol=1e-4)


def test_intervals_hold_future_changes():
    made = breaks.fit(*planted([(250, 0.2), (600, -0.3)]))
    line = breaks.fit(*planted([]))
    reach = made.deviation(np.array([1, 7, 60]))
    assert reach[0] == pytest.approx(made.spread, rel=0.01) and reach[2] > reach[1] > reach[0]
    assert line.deviation(np.array([60]))[0] == line.spread


def daily(spark, sets):
    rows = [
        (team, date(1970, 1, 1) + timedelta(days=int(d)), float(v)) for team, (days, y) in sets.items() for d, v in zip(days, y)
    ]
    return spark.createDataFrame(rows, "team string, ds date, y double")


def test_series_side_by_side(spark):
    frame = daily(spark, {"bent": planted([(400, 0.15)]), "straight": planted([]), "short": planted([], n=60)})
    found = breaks.trend_changes(frame).collect()
    day = (date(1970, 1, 1) + timedelta(days=10_400))
    assert [r.team for r in found] == ["bent"] and abs((found[0].changed_on - day).days) <= 7
    ahead = breaks.forecast(frame).groupBy("team").agg(F.count("*").alias("n"), F.min(F.col("yhat_upper") - F.col("yhat_lower")).alias("w"))
    assert {r.team: r.n for r in ahead.collect()} == {"bent": 7, "straight": 7}
    assert breaks.forecast(frame.limit(0)).collect() == [] == breaks.trend_changes(frame.limit(0)).collect()


def test_bending_is_better_after_a_change_and_no_worse_without(spark):
    frame = daily(spark, {"bent": planted([(450, 0.3)]), "straight": planted([])})
    tested = breaks.backtest(frame)
    by = {
        t: breaks.errors(tested.where(F.col("team") == t)).agg(F.avg("mae").alias("mae"), F.avg("mae_line").alias("line")).first()
        for t in ("bent", "straight")
    }
    assert by["bent"].mae < 0.5 * by["bent"].line and by["straight"].mae <= 1.02 * by["straight"].line
    assert tested.where("ds <= cutoff").count() == 0
