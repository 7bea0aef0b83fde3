"""Joins that treat null keys as ordinary values."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str],
                   how: str = "inner") -> DataFrame:
    """Join on equal keys, where null equals null; the keys come out once."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_right_{key}"))
    return left.join(renamed, condition, how).drop(*[f"_right_{k}" for k in keys])


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Key values of the child that the parent does not have, with their rows.

    Rows are counted per key before the anti join, so a hot key is one row.
    """
    counted = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows"))
    return counted.join(parent.select(key).distinct(), key, "left_anti")
