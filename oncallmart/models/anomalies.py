"""Isolation forest: trees grown on small samples, every ticket scored.

A tree needs 256 rows, so the samples of all trees together are small whatever
the size of the data. They are drawn by a hash, grown one tree per group, and the
finished trees (a fixed-size table) go to the scoring tasks.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oncallmart.operators import ordered
from oncallmart.session import settle

SAMPLE = 256
TREES = 100
FEATURES = [
    "duracao_horas", "horas_ate_resolucao", "prioridade_num", "hora_abertura",
    "dia_semana_num", "fora_horario_comercial", "possui_pai", "score_risco_operacional",
]


def average_path(n):
    """Mean depth of an unsuccessful search in a binary tree of n rows."""
    n = np.asarray(n, dtype=float)
    harmonic = np.log(np.maximum(n - 1, 1)) + np.euler_gamma
    return np.where(n > 2, 2 * harmonic - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def inputs(mart: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Id and an array of features. A missing value becomes the feature's mean, and every
    feature that may be missing is followed by a 0/1 flag, so open tickets are scored too."""
    means = mart.agg(F.struct(*[F.avg(c).alias(c) for c in features])).scalar()
    filled = mart.select("incident_id", *features).withColumn("_mean", means)
    values = [
        F.coalesce(F.col(c).cast("double"), F.col(f"_mean.{c}"), F.lit(0.0)) for c in features
    ]
    missing = [F.col(c).isNull().cast("double") for c in features if mart.schema[c].nullable]
    return filled.select("incident_id", F.array(*values, *missing).alias("x"))


def samples(points: DataFrame, rows: int, trees: int = TREES, size: int = SAMPLE,
            seed: int = 42) -> DataFrame:
    """`size` rows for each tree: a thin hash draw, then the smallest hashes.

    One hash of a ticket says whether it is drawn at all and for which trees; a ticket goes
    to several trees only if there are fewer tickets than all samples need.
    """
    wanted = 3 * size * trees
    copies = min(trees, max(1, math.ceil(wanted / max(rows, 1))))
    draw = F.xxhash64("incident_id", F.lit(seed))
    thin = F.pmod(draw, F.lit(max(rows, 1))) < wanted if rows > wanted else F.lit(True)
    first = F.pmod(F.shiftrightunsigned(draw, 20), F.lit(trees)).cast("int")
    step = F.sequence(F.lit(0), F.lit(copies - 1))
    numbers = F.transform(step, lambda k: F.pmod(first + k * max(1, trees // copies), F.lit(trees)))
    chosen = points.where(thin).select(
        "incident_id", "x", F.explode(F.array_distinct(numbers)).alias("tree")
    )
    order = F.xxhash64("incident_id", "tree", F.lit(seed + 1))
    place = F.row_number().over(Window.partitionBy("tree").orderBy(order, "incident_id"))
    return chosen.withColumn("place", place).where(F.col("place") <= size).drop("place")


def _grow(pdf: pd.DataFrame, seed: int) -> pd.DataFrame:
    """One tree as a heap: split feature (-1 for a leaf), threshold, leaf path length."""
    tree = int(pdf["tree"].iloc[0])
    x = np.stack(pdf.sort_values("incident_id")["x"].to_numpy())
    height = math.ceil(math.log2(max(len(x), 2)))
    slots = 2 ** (height + 1) - 1
    feature, threshold, path = np.full(slots, -1), np.zeros(slots), np.zeros(slots)
    random = np.random.default_rng([seed, tree])
    waiting = [(0, 0, x)]
    while waiting:
        slot, depth, rows = waiting.pop()
        varied = np.flatnonzero(rows.max(axis=0) > rows.min(axis=0)) if len(rows) > 1 else []
        if depth == height or len(varied) == 0:
            path[slot] = depth + float(average_path(len(rows)))
            continue
        column = random.choice(varied)
        cut = random.uniform(rows[:, column].min(), rows[:, column].max())
        left = rows[:, column] <= cut
        feature[slot], threshold[slot] = column, cut
        waiting += [(2 * slot + 1, depth + 1, rows[left]), (2 * slot + 2, depth + 1, rows[~left])]
    return pd.DataFrame(
        {"tree": [tree], "feature": [feature.tolist()], "threshold": [threshold.tolist()],
         "path": [path.tolist()], "sample": [len(x)]}
    )


def grow(points: DataFrame, trees: int = TREES, size: int = SAMPLE, seed: int = 42) -> list:
    """All trees; at most `trees` rows of fixed length come back."""
    drawn = samples(points, points.count(), trees, size, seed)
    grown = drawn.groupBy("tree").applyInPandas(
        lambda pdf: _grow(pdf, seed),
        "tree int, feature array<int>, threshold array<double>, path array<double>, sample int",
    )
    return grown.orderBy("tree").collect()


def score(points: DataFrame, forest: list) -> DataFrame:
    """Score of every row: the lower, the more isolated."""
    packed = [
        (np.array(t["feature"]), np.array(t["threshold"]), np.array(t["path"])) for t in forest
    ]
    norm = float(np.mean(average_path([t["sample"] for t in forest])))

    @F.pandas_udf("double")
    def isolation(x: pd.Series) -> pd.Series:
        if x.empty:
            return pd.Series([], dtype=float)
        rows = np.stack(x.to_numpy())
        index, total = np.arange(len(rows)), np.zeros(len(rows))
        for feature, threshold, path in packed:
            slot = np.zeros(len(rows), dtype=int)
            while True:
                split = feature[slot]
                inner = split >= 0
                if not inner.any():
                    break
                right = rows[index, np.maximum(split, 0)] > threshold[slot]
                slot = np.where(inner, 2 * slot + 1 + right, slot)
            total += path[slot]
        return pd.Series(-np.power(2.0, -(total / len(packed)) / norm))

    return points.withColumn("anomaly_score", isolation("x"))


def detect(mart: DataFrame, contamination: float = 0.05, features: list[str] = FEATURES,
           seed: int = 42) -> DataFrame:
    """Features, score and -1/1 flag; the share of the lowest scores is flagged."""
    points = settle(inputs(mart, features))
    scored = settle(score(points, grow(points, seed=seed)))
    cut = ordered.quantiles(scored, ["anomaly_score"], {"cut": contamination})
    return scored.withColumn("_cut", cut.select("cut").scalar()).select(
        "incident_id", *[F.get("x", F.lit(i)).alias(c) for i, c in enumerate(features)],
        F.when(F.col("anomaly_score") < F.col("_cut"), -1).otherwise(1).alias("anomaly"),
        "anomaly_score",
    )


def summary(detected: DataFrame) -> DataFrame:
    """Totals as (metric, value) rows."""
    score_column, found = F.col("anomaly_score"), F.count_if(F.col("anomaly") == -1)
    one = detected.agg(
        F.count("*").cast("double").alias("total_incidents"),
        found.cast("double").alias("anomalies_detected"),
        (F.lit(100.0) * found / F.count("*")).alias("pct_anomalies"),
        F.avg(score_column).alias("mean_anomaly_score"),
        F.stddev_pop(score_column).alias("std_anomaly_score"),
        F.min(score_column).alias("min_anomaly_score"),
        F.max(score_column).alias("max_anomaly_score"),
    )
    pairs = [F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in one.columns]
    return one.select(F.inline(F.array(*pairs)))
