"""Daily series: gaps, lags, hold-outs, folds, baselines and their errors."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oncallmart.functions import calendar as C
from oncallmart.functions import numeric as N


def fill_days(daily: DataFrame, by: str = "team") -> DataFrame:
    """One row per series and day between the series' first and last day; gaps are 0."""
    days = daily.groupBy(by).agg(F.min("ds").alias("lo"), F.max("ds").alias("hi")).select(
        by, F.explode(F.sequence("lo", "hi")).alias("ds")
    )
    return days.join(daily, [by, "ds"], "left").select(
        by, "ds", F.coalesce("y", F.lit(0)).alias("y")
    )


def lags(filled: DataFrame, by: str = "team") -> DataFrame:
    """Yesterday, a week ago, and the mean of the seven days before."""
    order = Window.partitionBy(by).orderBy("ds")
    week = order.rowsBetween(-7, -1)
    return filled.select(
        by, "ds", "y",
        F.lag("y", 1).over(order).alias("lag_1"),
        F.lag("y", 7).over(order).alias("lag_7"),
        (F.sum("y").over(week) / F.count("y").over(week)).alias("media_7d"),
    )


def with_holdout(daily: DataFrame, by: str = "team", last: int = 30) -> DataFrame:
    """Mark the last observed days of each series as test data."""
    newest = Window.partitionBy(by).orderBy(F.desc("ds"))
    return daily.withColumn("is_test", F.row_number().over(newest) <= last)


def long_enough(daily: DataFrame, by: str = "team", days: int = 60) -> DataFrame:
    """Series with at least `days` observed days.

    Counted by a window over the daily rows of a series: the later windows and fits
    by series then find the rows already in place.
    """
    observed = F.count("*").over(Window.partitionBy(by))
    return daily.withColumn("n_days", observed).where(F.col("n_days") >= days)


def cutoffs(daily: DataFrame, by: str, initial: int = 90, period: int = 30,
            horizon: int = 7) -> DataFrame:
    """Rolling-origin cut-offs: back from the last day, leaving `initial` days to train."""
    span = daily.groupBy(by).agg(F.min("ds").alias("lo"), F.max("ds").alias("hi"))
    first, last = F.date_add("lo", initial), F.date_sub("hi", horizon)
    folds = F.floor(F.date_diff(last, first) / period).cast("int")
    return span.where(folds >= 0).select(
        by,
        F.explode(F.sequence(F.lit(0), folds)).alias("back"),
        last.alias("last"),
    ).select(by, F.date_sub("last", F.col("back") * period).alias("cutoff"))


def fold_sizes(daily: DataFrame, by: str = "team", initial: int = 90, period: int = 30,
               horizon: int = 7) -> DataFrame:
    """Training and test days of each fold.

    A day can be tested by one fold only (the horizon is shorter than the period),
    and the training size is a running count, so no day is paired with all folds.
    """
    folds = cutoffs(daily, by, initial, period, horizon)
    running = Window.partitionBy(by).orderBy("at", "kind").rowsBetween(
        Window.unboundedPreceding, 0
    )
    # Days and cut-offs on one line per series; a cut-off sorts after its own day.
    line = daily.select(by, F.col("ds").alias("at"), F.lit(0).alias("kind")).unionByName(
        folds.select(by, F.col("cutoff").alias("at"), F.lit(1).alias("kind"))
    ).unionByName(
        folds.select(by, F.date_add("cutoff", horizon).alias("at"), F.lit(2).alias("kind"))
    )
    counted = line.withColumn("seen", F.count_if(F.col("kind") == 0).over(running))
    return (
        counted.where(F.col("kind") > 0)
        .withColumn(
            "cutoff",
            F.when(F.col("kind") == 1, F.col("at")).otherwise(F.date_sub("at", horizon)),
        )
        .groupBy(by, "cutoff")
        .agg(
            F.max(F.when(F.col("kind") == 1, F.col("seen"))).alias("n_train"),
            (F.max(F.when(F.col("kind") == 2, F.col("seen")))
             - F.max(F.when(F.col("kind") == 1, F.col("seen")))).alias("n_test"),
        )
    )


def naive_forecasts(marked: DataFrame, by: str = "team") -> DataFrame:
    """Seasonal-naive (same weekday, latest training week) and weekday-mean forecasts."""
    train = marked.where(~F.col("is_test")).withColumn("dow", C.day_of_week(F.col("ds")))
    by_weekday = train.groupBy(by, "dow").agg(
        F.max_by("y", "ds").alias("naive"),
        (F.sum("y") / F.count("*")).alias("weekday_mean"),
    )
    test = marked.where("is_test").withColumn("dow", C.day_of_week(F.col("ds")))
    return test.join(by_weekday, [by, "dow"], "left").select(
        by, "ds", "y", "naive", "weekday_mean"
    )


def error_metrics(frame: DataFrame, actual: str, predicted: str, by: list[str] = ()) -> DataFrame:
    """MAPE (days with no tickets left out), MAE and RMSE."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    error = y - p
    return frame.where(p.isNotNull()).groupBy(*by).agg(
        F.count("*").alias("n"),
        F.round(F.avg(F.abs(error) / F.nullif(y, F.lit(0.0))), 6).alias("mape"),
        F.round(F.avg(F.abs(error)), 6).alias("mae"),
        F.round(F.sqrt(F.avg(error * error)), 6).alias("rmse"),
        F.round(F.avg(N.error_percent(y, p)), 6).alias("erro_pct"),
    )


def horizon_metrics(predictions: DataFrame) -> DataFrame:
    """Mean and deviation of the errors by days ahead, over all folds."""
    y, p = F.col("y").cast("double"), F.col("yhat").cast("double")
    relative = F.abs(y - p) / F.nullif(y, F.lit(0.0))
    squared = (y - p) * (y - p)
    return predictions.groupBy("horizon").agg(
        F.count("*").alias("n"),
        F.round(F.avg(relative), 6).alias("mape_mean"),
        F.round(F.stddev_samp(relative), 6).alias("mape_std"),
        F.round(F.sqrt(F.avg(squared)), 6).alias("rmse"),
        F.round(F.avg(F.abs(y - p)), 6).alias("mae"),
    )


def naive_backtest(filled: DataFrame, by: str = "team", initial: int = 90, period: int = 30,
                   horizon: int = 7) -> DataFrame:
    """Seasonal-naive predictions for every fold: the value seven days earlier."""
    folds = cutoffs(filled, by, initial, period, horizon)
    # The fold that tests a day follows from arithmetic on its date.
    tested = folds.select(
        by, "cutoff", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("horizon")
    ).withColumn("ds", F.date_add("cutoff", F.col("horizon")))
    earlier = filled.select(by, F.date_add("ds", 7).alias("ds"), F.col("y").alias("yhat"))
    return tested.join(filled, [by, "ds"]).join(earlier, [by, "ds"]).select(
        by, "cutoff", "horizon", "ds", "y", "yhat"
    )


def mean_filled(daily: DataFrame, column: str) -> DataFrame:
    mean = daily.agg(F.avg(column)).scalar()
    return daily.withColumn(column, F.coalesce(column, mean))
