"""Scores against labels: confusion counts, PR and ROC, clusters."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oncallmart.operators import ordered

TINY = 1e-10


def confusion(frame: DataFrame, label: str, predicted: str, by: list[str] = ()) -> DataFrame:
    """Counts and the usual ratios, in one pass."""
    y, p = F.col(label), F.col(predicted)
    counts = frame.groupBy(*by).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def ratio(part, whole):
        return F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0))

    return counts.select(
        *by, "tp", "fp", "fn", "tn",
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def by_score(frame: DataFrame, label: str, score: str, by: list[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score, with the counts below it."""
    counts = frame.groupBy(*by, F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    return ordered.running_sums(counts, "score", ["pos", "neg"], by)


def pr_curve(frame: DataFrame, label: str, score: str) -> DataFrame:
    """Precision, recall and F1 when every score at or above the threshold is flagged."""
    placed = by_score(frame, label, score)
    tp = F.col("pos_total") - F.col("pos_before")
    fp = F.col("neg_total") - F.col("neg_before")
    precision, recall = tp / (tp + fp), tp / F.nullif(F.col("pos_total"), F.lit(0))
    f1 = F.lit(2.0) * (precision * recall) / (precision + recall + F.lit(TINY))
    return placed.select(
        F.col("score").alias("threshold"), tp.alias("tp"), fp.alias("fp"),
        precision.alias("precision"), recall.alias("recall"), f1.alias("f1"),
    )


def best_threshold(curve: DataFrame) -> DataFrame:
    """The lowest threshold with the highest F1."""
    best = F.max_by(F.struct("threshold", "precision", "recall", "f1"),
                    F.struct(F.round("f1", 12), -F.col("threshold")))
    return curve.agg(best.alias("b")).select("b.*")


def roc_curve(frame: DataFrame, label: str, score: str) -> DataFrame:
    placed = by_score(frame, label, score)
    tp = F.col("pos_total") - F.col("pos_before")
    fp = F.col("neg_total") - F.col("neg_before")
    return placed.select(
        F.col("score").alias("threshold"),
        (fp / F.nullif(F.col("neg_total"), F.lit(0))).alias("fpr"),
        (tp / F.nullif(F.col("pos_total"), F.lit(0))).alias("tpr"),
    )


def auc(frame: DataFrame, label: str, score: str, by: list[str] = ()) -> DataFrame:
    """Area under the ROC curve: positives ranked above negatives, ties as half."""
    placed = by_score(frame, label, score, by)
    pos, neg, below = (F.col(c).cast("double") for c in ("pos", "neg", "neg_before"))
    return placed.groupBy(*by).agg(
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"),
        F.round(F.sum(pos * (below + neg / 2)) / (F.sum(pos) * F.sum(neg)), 9).alias("auc"),
    )


def cluster_profile(frame: DataFrame, label: str, columns: list[str]) -> DataFrame:
    """Mean of each column per cluster, and that mean scaled to 0..1 across clusters."""
    means = frame.groupBy(label).agg(*[F.avg(c).alias(c) for c in columns])
    across = Window.partitionBy()
    scaled = [
        F.round(
            (F.col(c) - F.min(c).over(across))
            / (F.max(c).over(across) - F.min(c).over(across) + F.lit(1e-9)),
            6,
        ).alias(f"{c}_norm")
        for c in columns
    ]
    return means.select(label, *[F.round(c, 6).alias(c) for c in columns], *scaled)


def cluster_stats(frame: DataFrame, label: str, columns: list[str]) -> DataFrame:
    """Mean, deviation, minimum and maximum: one row per cluster and column."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
          for c in columns]
    )
    return frame.select(label, F.inline(pairs)).groupBy(label, "column").agg(
        F.round(F.avg("value"), 6).alias("mean"),
        F.round(F.stddev_samp("value"), 6).alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )


def cluster_balance(frame: DataFrame, label: str, low: float = 10, high: float = 40) -> DataFrame:
    """Size and share of each cluster, and whether all shares lie inside the limits."""
    counts = frame.groupBy(label).agg(F.count("*").alias("count"))
    across = Window.partitionBy()
    share = F.lit(100.0) * F.col("count") / F.sum("count").over(across)
    sized = counts.withColumn("percentage", share)
    inside = (F.col("percentage") > low) & (F.col("percentage") < high)
    return sized.select(
        label, "count", "percentage",
        F.when(inside, "OK").otherwise("CHECK").alias("status"),
        F.when(F.min(inside).over(across), "EQUILIBRADO")
        .when(F.min("percentage").over(across) > 1, "MELHORADO")
        .otherwise("DEGENERADO").alias("overall"),
    )


def box_plot(frame: DataFrame, column: str, by: str) -> DataFrame:
    """Quartiles, whisker ends (last values within 1.5 IQR) and outliers per group."""
    quartiles = ordered.quantiles(
        frame, [column], {"q1": 0.25, "median": 0.5, "q3": 0.75}, [by]
    ).drop("column")
    # Groups are few; the quartile table is one row per group.
    joined = frame.where(F.col(column).isNotNull()).join(quartiles, by)
    value = F.col(column)
    reach = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    inside = (value >= F.col("q1") - reach) & (value <= F.col("q3") + reach)
    return joined.groupBy(by).agg(
        F.count("*").alias("n"),
        F.round(F.max("q1"), 6).alias("q1"),
        F.round(F.max("median"), 6).alias("median"),
        F.round(F.max("q3"), 6).alias("q3"),
        F.min(F.when(inside, value)).alias("whisker_low"),
        F.max(F.when(inside, value)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )
