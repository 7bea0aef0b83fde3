"""Running sums and exact quantiles that never sort a whole column in one task."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oncallmart.operators.joins import null_safe_join
from oncallmart.session import settle

LEVELS = 9  # 512 buckets


def running_sums(counts: DataFrame, order: str, sums: list[str], by: list[str] = (),
                 levels: int = LEVELS) -> DataFrame:
    """Add `<c>_before`, the sum of c over the rows with a smaller order value, and
    `<c>_total`, its sum over the group.

    `counts` must hold one row per (by, order). Each group's distinct values are
    cut into 2**levels about equal buckets at approximate percentiles; bucket
    totals (one row per group and bucket) give every bucket its offset, and the
    exact running sum is then a window inside one bucket. The cuts only balance
    the work: any cuts give the same result.
    """
    by = list(by)
    buckets = 2**levels
    steps = [i / buckets for i in range(1, buckets)]
    # Read three times below; stored, whatever lies under it runs once.
    counts = settle(counts)
    stats = counts.groupBy(*by).agg(
        F.percentile_approx(order, steps, 20 * buckets).alias("_cuts"),
        *[F.sum(c).alias(f"{c}_total") for c in sums],
    )
    if by:
        placed = null_safe_join(counts, stats, by)
    else:
        row = stats.select(F.struct(*stats.columns)).scalar()
        placed = counts.withColumn("_row", row).select(*counts.columns, "_row.*")
    # Number of cuts below the value, by halving: one array access per level.
    placed = placed.withColumn("_bucket", F.lit(0))
    for step in (2**level for level in reversed(range(levels))):
        below = F.get("_cuts", F.col("_bucket") + (step - 1)) < F.col(order)
        placed = placed.withColumn(
            "_bucket", F.col("_bucket") + F.when(below, step).otherwise(0)
        )
    placed = placed.drop("_cuts")

    totals = placed.groupBy(*by, "_bucket").agg(*[F.sum(c).alias(f"_{c}") for c in sums])
    earlier = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = totals.select(
        *by, "_bucket",
        *[F.coalesce(F.sum(f"_{c}").over(earlier), F.lit(0)).alias(f"_{c}") for c in sums],
    )
    inside = Window.partitionBy(*by, "_bucket").orderBy(order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    return null_safe_join(placed, offsets, [*by, "_bucket"]).select(
        *counts.columns,
        *[f"{c}_total" for c in sums],
        *[
            (F.col(f"_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(f"{c}_before")
            for c in sums
        ],
    )


def melt(frame: DataFrame, columns: list[str], by: list[str] = ()) -> DataFrame:
    """One row per (row, column) with the value as double; nulls are left out."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
          for c in columns]
    )
    return (
        frame.select(*by, F.inline(pairs)).where(F.col("value").isNotNull())
    )


def quantiles(frame: DataFrame, columns: list[str], points: dict[str, float],
              by: list[str] = ()) -> DataFrame:
    """Exact linear-interpolation quantiles: one row per (by, column).

    Values are counted first, so the shuffle carries distinct values only, and
    the two neighbours of every quantile are then picked by their running count.
    Unlike the built-in `percentile`, no task holds all values of a group.
    """
    by = list(by)
    counts = melt(frame, columns, by).groupBy(*by, "column", "value").agg(
        F.count("*").alias("n")
    )
    keys = [*by, "column"]
    placed = running_sums(counts, "value", ["n"], keys)

    def holds(index: Column) -> Column:
        before = F.col("n_before")
        return (before <= index) & (index < before + F.col("n"))

    picks = []
    for name, p in points.items():
        position = F.lit(p) * (F.col("n_total") - 1)
        low, high = F.floor(position), F.ceil(position)
        picks += [
            F.max(F.when(holds(low), F.col("value"))).alias(f"_{name}_low"),
            F.max(F.when(holds(high), F.col("value"))).alias(f"_{name}_high"),
            F.max(position - low).alias(f"_{name}_part"),
        ]
    found = placed.groupBy(*keys).agg(*picks)

    def between(name: str) -> Column:
        low, high = F.col(f"_{name}_low"), F.col(f"_{name}_high")
        return low + (high - low) * F.col(f"_{name}_part")

    return found.select(*keys, *[between(name).alias(name) for name in points])


def as_one_row(stats: DataFrame, columns: list[str], values: list[str]) -> Column:
    """Per-column statistics as one struct `<column>_<value>`, for use in a projection."""
    picked = [
        F.max(F.when(F.col("column") == c, F.col(v))).alias(f"{c}_{v}")
        for c in columns
        for v in values
    ]
    return stats.agg(F.struct(*picked).alias("s")).scalar()
