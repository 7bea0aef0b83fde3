"""What the planner makes of the queries."""

import re

import pytest
from pyspark.sql import functions as F

from oncallmart import registry
from oncallmart.operators import silver
from oncallmart.sources import fixtures, sinks


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_date_filter_reaches_the_scan(spark, small, tmp_path):
    fixtures.bronze(spark, small).write.parquet(str(tmp_path / "b"))
    text = plan(silver.canonical_silver(spark.read.parquet(str(tmp_path / "b")), "1999-01-01"))
    assert "GreaterThanOrEqual(Aberto,1999-01-01T00:00" in text


def test_month_filter_prunes_partitions(spark, small, tmp_path):
    made = silver.silver(fixtures.bronze(spark, small))
    sinks.write_monthly(made, str(tmp_path / "s"))
    text = plan(spark.read.parquet(str(tmp_path / "s")).where(F.col("Ano_Mes") >= "2000-01"))
    assert re.search(r"PartitionFilters: \[[^\]]*Ano_Mes", text)


def test_unused_joins_and_columns_are_dropped(spark, small):
    text = plan(registry.QUERIES["volume_hour"](spark, small))
    assert "lineitem" not in text and "customer" not in text and "part.parquet" not in text
    assert "o_totalprice" not in text


def test_only_the_product_join_is_kept(spark, small):
    text = plan(registry.QUERIES["dim_grupo"](spark, small))
    assert "customer" in text and "lineitem" not in text


def test_top_k_is_not_a_global_sort(spark, small):
    assert "TakeOrderedAndProject" in plan(registry.QUERIES["top_categories"](spark, small))


def test_levels_are_limited_before_the_shuffle(spark, small):
    assert "WindowGroupLimit" in plan(registry.QUERIES["onehot_levels"](spark, small))


@pytest.mark.parametrize(
    "name", ["star_join", "roc_auc", "pr_curve", "duration_summary", "lags_rolling", "mart_daily"]
)
def test_no_cartesian_products(spark, small, name):
    text = plan(registry.QUERIES[name](spark, small))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_status_join_needs_no_sort_aggregate(spark, small):
    assert "SortAggregate(key=[dim_status" not in plan(registry.QUERIES["star_join"](spark, small))


def test_series_are_shuffled_once(spark, base):
    """Guard, hold-out and fit of each series share the shuffle of its daily counts."""
    from oncallmart.models import forecast
    from oncallmart.operators import analytics

    text = plan(forecast.holdout_by_group(analytics.team_daily(base)))
    assert text.count("Exchange hashpartitioning") == 2  # by (team, day), then by team


@pytest.mark.parametrize(
    "name", ["quality_unique", "quality_not_null", "quality_models", "table_counts_union", "scalar_checks"]
)
def test_checks_scan_the_source_once(spark, small, name):
    """The stored copy is written by one scan of the source; the checks read only the copy."""
    made = registry.QUERIES[name](spark, small)
    made.collect()
    text = made._jdf.queryExecution().executedPlan().toString()
    assert "orders.parquet" not in text and "settled-" in text


def test_settled_copies_can_be_discarded(spark, tmp_path):
    from pathlib import Path

    from oncallmart import session

    before = session.settled(spark)
    copy = session.settle(spark.range(3).toDF("x"))
    folder = Path(copy.inputFiles()[0].removeprefix("file://")).parent
    assert folder.exists() and session.discard_settled(spark, before) == 1 and not folder.exists()


def test_star_join_meets_the_long_dimension_first(spark, small):
    """The dimension as long as the fact is joined before the attributes of the others are there
    to be moved; the columns keep their order."""
    joined = registry.QUERIES["star_join"](spark, small)
    names, threshold = joined.columns, spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        large = registry.QUERIES["star_join"](spark, small)
        rows = {tuple(r) for r in large.collect()}
        final = large._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    joins = [line for line in final.splitlines() if "Join [dim_" in line]
    assert len(joins) == 6 and "[dim_abertura_sk" in joins[-1]
    assert rows == {tuple(r) for r in joined.collect()}
    assert names[:6] == ["dim_abertura_sk", "dim_tempo_sk", "dim_status_sk", "dim_produto_categoria_sk",
                         "dim_prioridade_sk", "dim_grupo_sk"]
