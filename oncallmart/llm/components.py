"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oncallmart.session import settle


def _state(links: DataFrame) -> tuple:
    row = links.agg(
        F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("bigint"))
    ).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """`edges` has two id columns; the result has (id, component) for every id in them, with
    the smallest reachable id as component. Ids reachable only from themselves, and rows with
    a null, are left out; without edges the result is empty.

    A round points every neighbour of an id at the smallest neighbour. All steps are grouped
    minima and joins, so an id with very many links is no single task's group; the rounds
    grow with the logarithm of the longest path.
    """
    one, two = edges.columns
    links = settle(
        edges.where(F.col(one) != F.col(two))
        .select(F.greatest(one, two).alias("a"), F.least(one, two).alias("b"))
        .distinct()
    )
    before = _state(links)
    while before[0]:
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        ).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a")
            .select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("x"))
            .select("x.a", F.col("x.m").alias("b"))
            .where("a != b")
            .distinct()
        )
        links = settle(small)
        after = _state(links)
        if after == before:
            break
        before = after
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )
