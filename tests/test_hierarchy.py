"""Roots against a walk along the chain, and places of many levels."""

import random
from collections import Counter

from pyspark.sql import functions as F

from oncallmart.operators import hierarchy, prep


def walk(up, at):
    seen, depth = set(), 0
    while at in up:
        if at in seen:
            return None, None
        seen.add(at)
        at, depth = up[at], depth + 1
    return at, depth


def found(spark, pairs):
    frame = spark.createDataFrame(pairs, "Numero string, Incidente_Pai string")
    return {r.Numero: (r.root, r.depth) for r in hierarchy.roots(frame).collect()}


def test_chains_circles_and_missing_parents(spark):
    pick = random.Random(1)
    up = {f"t{k}": f"t{pick.randrange(k)}" for k in range(1, 300) if k % 7}
    up |= {f"c{k}": f"c{k + 1}" for k in range(100)}
    up |= {"a": "b", "b": "c", "c": "a", "d": "a", "self": "self", "e": "gone"}
    pairs = list(up.items()) + [("t0", None), (None, "t5")]
    assert found(spark, pairs) == {k: walk(up, k) for k in up}


def test_one_hot_root_and_repeated_rows(spark):
    pairs = [(f"k{n}", "hot") for n in range(500)] + [("hot", "top"), ("k1", "hot"), ("k2", "zz")]
    got = found(spark, pairs)
    assert got["k7"] == ("top", 2) and got["hot"] == ("top", 1) and got["k2"] == ("top", 2) and len(got) == 501


def test_no_links(spark):
    assert found(spark, [("a", None)]) == {}


def test_counts_by_root_and_depth(spark):
    rows = [("a", None, 1), ("b", "a", 1), ("c", "a", 0), ("d", "c", 1)]
    frame = spark.createDataFrame(rows, "Numero string, Incidente_Pai string, Exige_Intervencao int")
    got = {tuple(r) for r in hierarchy.descendants(frame).collect()}
    assert got == {("a", 1, 2, 1), ("a", 2, 1, 1)}


def test_places_of_a_hundred_thousand_levels(spark):
    wide = spark.range(100_000).select(
        F.concat(F.lit("x"), "id").alias("many"), F.concat(F.lit("g"), F.floor(F.sqrt("id"))).alias("few"),
        F.when(F.col("id") % 3 > 0, "a").alias("gaps"),
    )
    levels = prep.numbered_levels(wide, ["many", "few", "gaps"])
    for column, count in (("many", 100_000), ("few", 317), ("gaps", 2)):
        rows = levels.where(F.col("column") == column).select("level", "n", "place").collect()
        assert sorted(r.place for r in rows) == list(range(count))
        by_place = [r.n for r in sorted(rows, key=lambda r: r.place)]
        assert by_place == sorted(by_place, reverse=True)
    assert Counter(r["level"] for r in levels.where("column = 'gaps'").collect()) == {"a": 1, "unknown": 1}
    # No window over all levels of a column.
    plan = levels._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [row_number" in line]
    assert windows and all("_prefix" in line for line in windows)
