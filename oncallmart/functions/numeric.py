"""Small numeric expressions."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, whole: Column) -> Column:
    """part / whole * 100, null when there is nothing to divide by."""
    return F.lit(100.0) * part / F.nullif(whole, F.lit(0))


def percent_2(part: Column, whole: Column) -> Column:
    """Percentage rounded half-up to two places in decimal arithmetic."""
    exact = (part.cast("decimal(20,0)") * 100) / F.nullif(whole.cast("decimal(20,0)"), F.lit(0))
    return F.round(exact, 2).cast("double")


def cycle(value: Column, period: int) -> tuple[Column, Column]:
    angle = F.lit(2 * math.pi) * value / period
    return F.sin(angle), F.cos(angle)


def error_percent(actual: Column, predicted: Column) -> Column:
    """Absolute error against actual + 1, so empty days stay finite."""
    return F.abs(actual - predicted) / (actual + 1) * 100


def hash_percent(identifier: Column, seed: int) -> Column:
    """A number 0..99 that depends only on the identifier and the seed."""
    digest = F.md5(F.concat(identifier, F.lit(f"#{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100


def hash_rank(identifier: Column, seed: int) -> Column:
    return F.md5(F.concat(identifier, F.lit(f"#{seed}")))
