"""Daily forecasts whose trend may bend: a sparse piecewise-linear trend for each series.

The trend is a line and a change of slope at any of many days, a week apart. An L1 penalty on
the changes, solved by coordinate descent on their Gram matrix along a path of penalties, says
which days come into question; of each such set, changes are dropped one by one as long as the
information criterion falls, and the best set is fitted without a penalty. A series without
breaks keeps the plain line. Intervals hold the noise and the changes that may still come: of
the size and as often as those found, their effect grows with the cube of the horizon.

A group holds one row per day of one series, so its size is bounded by the calendar.
"""

from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oncallmart.models.forecast import WEEKLY_WAVES
from oncallmart.operators import series

# Days between candidates, days at both ends without one, most changes at a time, and steps.
SPACING, MARGIN, MOST, PATH = 7, 21, 20, 25


def waves(days: np.ndarray, yearly: int) -> np.ndarray:
    """Weekly and yearly waves of day numbers."""
    columns = []
    for period, count in ((7.0, WEEKLY_WAVES), (365.25, yearly)):
        for k in range(1, count + 1):
            columns += [np.sin(2 * np.pi * k * days / period), np.cos(2 * np.pi * k * days / period)]
    return np.stack(columns, axis=1) if columns else np.empty((len(days), 0))


def lasso(gram: np.ndarray, q: np.ndarray, penalty: float, start: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """Coordinate descent for columns of length one: min |y - Cx|^2 / 2 + penalty * |x|_1."""
    x, left = start.copy(), q - gram @ start
    for _ in range(sweeps):
        moved = 0.0
        # Columns that are out and inside the penalty stay out, and are not visited.
        for j in np.flatnonzero((x != 0) | (np.abs(left) > penalty)):
            free = left[j] + x[j]
            new = np.sign(free) * max(abs(free) - penalty, 0.0)
            if new != x[j]:
                left -= gram[:, j] * (new - x[j])
                moved = max(moved, abs(new - x[j]))
                x[j] = new
        if moved < 1e-6 * max(1.0, np.abs(x).max()):
            break
    return x


@dataclass
class Trend:
    """A fitted series: weights of the plain part, days of the changes and their slopes."""

    first: float
    yearly: int
    weights: np.ndarray
    changes: np.ndarray
    slopes: np.ndarray
    spread: float
    # Candidates a day and the mean size of a change over all of them.
    rate: float
    size: float

    def predict(self, days: np.ndarray) -> np.ndarray:
        return plain(days, self.first, self.yearly) @ self.weights + hinges(days, self.changes) @ self.slopes

    def deviation(self, ahead: np.ndarray) -> np.ndarray:
        """Of a prediction so many days after the last one."""
        return np.sqrt(self.spread**2 + 2 * self.size**2 * self.rate * np.maximum(ahead, 0) ** 3 / 3)


def plain(days: np.ndarray, first: float, yearly: int) -> np.ndarray:
    return np.column_stack([np.ones(len(days)), (days - first) / 365.25, waves(days, yearly)])


def hinges(days: np.ndarray, changes: np.ndarray) -> np.ndarray:
    return np.maximum(days[:, None] - changes[None, :], 0.0) / 365.25


def criterion(rss: float, n: int, changes: int) -> float:
    """Each change costs its day and its slope."""
    return n * np.log(max(rss / n, 1e-12)) + 2 * changes * np.log(n)


def fit(days: np.ndarray, y: np.ndarray, yearly: int = 0, bends: bool = True) -> Trend:
    """Trend of one series; days as numbers, in order."""
    days, first, n = days.astype(float), float(days.min()), len(days)
    base = plain(days, first, yearly)
    q, _ = np.linalg.qr(base)
    candidates = np.arange(first + MARGIN, days.max() - MARGIN + 1, SPACING) if bends else np.empty(0)

    def rest(columns: np.ndarray) -> np.ndarray:
        return columns - q @ (q.T @ columns)

    target = rest(y)
    columns = rest(hinges(days, candidates))
    norms = np.sqrt((columns**2).sum(axis=0))
    use = norms > 1e-9
    candidates, columns = candidates[use], columns[:, use]

    unit = columns / norms[use]
    gram, against, whole = unit.T @ unit, unit.T @ target, float(target @ target)

    def left(chosen) -> float:
        """What the plain part and some changes leave, from the products of the columns."""
        part = against[chosen]
        ridge = 1e-10 * np.eye(len(chosen))
        return max(whole - float(part @ np.linalg.solve(gram[np.ix_(chosen, chosen)] + ridge, part)), 0.0)

    best, least, tried = [], criterion(whole, n, 0), set()
    if len(candidates):
        x, penalty = np.zeros(len(candidates)), float(np.abs(against).max())
        for _ in range(PATH):
            penalty *= 0.75
            x = lasso(gram, against, penalty, x)
            # Neighbours share one change: the largest of a run of them stands for it.
            at = np.flatnonzero(x)
            runs = np.split(at, np.flatnonzero(np.diff(at) > 2) + 1) if len(at) else []
            chosen = [int(r[np.abs(x[r]).argmax()]) for r in runs]
            if len(chosen) > MOST:
                break
            if tuple(chosen) in tried:
                continue
            tried.add(tuple(chosen))
            chosen, value = _moved(chosen, left, len(candidates), n)
            while chosen:
                smaller = [[c for c in chosen if c != d] for d in chosen]
                costs = [criterion(left(s), n, len(s)) if s else criterion(whole, n, 0) for s in smaller]
                k = int(np.argmin(costs))
                if costs[k] > value:
                    break
                chosen, value = smaller[k], costs[k]
            if value < least:
                best, least = _moved(chosen, left, len(candidates), n)
    changes = candidates[sorted(best)]
    final = np.column_stack([base, hinges(days, changes)])
    weights = np.linalg.lstsq(final, y, rcond=None)[0]
    slopes = weights[base.shape[1]:]
    spread = float(np.sqrt(np.mean((y - final @ weights) ** 2)))
    size = float(np.abs(slopes).sum()) / 365.25 / max(len(candidates), 1)
    return Trend(first, yearly, weights[: base.shape[1]], changes, slopes, spread, 1 / SPACING, size)


def _moved(chosen: list[int], left, candidates: int, n: int):
    """Each change moved to a neighbouring candidate as long as that fits better."""
    if not chosen:
        return chosen, float("inf")
    value = left(chosen)
    for _ in range(10):
        before = value
        for k in range(len(chosen)):
            for step in (-1, 1):
                other = chosen[:k] + [chosen[k] + step] + chosen[k + 1:]
                if 0 <= other[k] < candidates and len(set(other)) == len(other) and (cost := left(other)) < value:
                    chosen, value = other, cost
        if value == before:
            break
    return sorted(chosen), criterion(value, n, len(chosen))


# --- On Spark ------------------------------------------------------------------------------


def _numbers(ds: pd.Series) -> np.ndarray:
    return pd.to_datetime(ds).to_numpy("datetime64[D]").astype(np.int64)


def _kind(daily: DataFrame, by: str) -> str:
    return f"`{by}` {daily.schema[by].dataType.simpleString()}"


def trend_changes(daily: DataFrame, by: str = "team", yearly: int = 0, min_days: int = 120) -> DataFrame:
    """Each change of the trend: (by, changed_on, slope_change), in tickets a day and year."""
    def find(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ds")
        made = fit(_numbers(pdf["ds"]), pdf["y"].to_numpy(float), yearly)
        return pd.DataFrame({
            by: pd.Series([pdf[by].iloc[0]] * len(made.changes), dtype=object),
            "changed_on": made.changes.astype("datetime64[D]").astype(object), "slope_change": made.slopes,
        })

    kept = series.long_enough(daily, by, min_days).select(by, "ds", F.col("y").cast("double").alias("y"))
    return kept.groupBy(by).applyInPandas(find, f"{_kind(daily, by)}, changed_on date, slope_change double")


def forecast(daily: DataFrame, by: str = "team", horizon: int = 7, level: float = 0.95, yearly: int = 0,
             min_days: int = 120) -> DataFrame:
    """The next days of every series from its own last day on, with intervals."""
    z = NormalDist().inv_cdf(0.5 + level / 2)

    def predict(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ds")
        days = _numbers(pdf["ds"])
        made, ahead = fit(days, pdf["y"].to_numpy(float), yearly), np.arange(1, horizon + 1)
        yhat, reach = made.predict(days[-1] + ahead.astype(float)), z * made.deviation(ahead)
        return pd.DataFrame({
            by: pd.Series([pdf[by].iloc[0]] * horizon, dtype=object), "ds": (days[-1] + ahead).astype("datetime64[D]").astype(object),
            "yhat": yhat, "yhat_lower": yhat - reach, "yhat_upper": yhat + reach,
        })

    kept = series.long_enough(daily, by, min_days).select(by, "ds", F.col("y").cast("double").alias("y"))
    return kept.groupBy(by).applyInPandas(
        predict, f"{_kind(daily, by)}, ds date, yhat double, yhat_lower double, yhat_upper double"
    )


def backtest(daily: DataFrame, by: str = "team", yearly: int = 0, initial: int = 365, period: int = 90,
             horizon: int = 7) -> DataFrame:
    """Both trends refitted at every cut-off: (by, ds, y, cutoff, horizon, yhat, yhat_line)."""
    def refit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ds")
        seen = (pd.to_datetime(pdf["ds"]) <= pd.to_datetime(pdf["cutoff"])).to_numpy()
        days, y = _numbers(pdf["ds"]), pdf["y"].to_numpy(float)
        out = pdf.loc[~seen, [by, "ds", "y", "cutoff"]].copy()
        out["horizon"] = days[~seen] - _numbers(pdf["cutoff"])[~seen]
        for name, bends in (("yhat", True), ("yhat_line", False)):
            out[name] = fit(days[seen], y[seen], yearly, bends).predict(days[~seen].astype(float))
        return out

    chosen = daily.select(by, "ds", F.col("y").cast("double").alias("y"))
    rows = chosen.join(series.cutoffs(chosen, by, initial, period, horizon).select(by, "cutoff"), by).where(
        F.col("ds") <= F.date_add("cutoff", horizon)
    )
    return rows.groupBy(by, "cutoff").applyInPandas(
        refit, f"{_kind(daily, by)}, ds date, y double, cutoff date, horizon int, yhat double, yhat_line double"
    )


def errors(predictions: DataFrame) -> DataFrame:
    """Mean absolute error by days ahead, of the bending trend and of the line."""
    def miss(name: str):
        return F.avg(F.abs(F.col("y") - F.col(name)))

    return predictions.groupBy("horizon").agg(
        F.count("*").alias("n"), miss("yhat").alias("mae"), miss("yhat_line").alias("mae_line")
    )
