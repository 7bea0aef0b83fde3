"""Sinks, the daily run and the incremental load, in temporary folders."""

import pytest
from pyspark.sql import functions as F

from oncallmart import registry
from oncallmart import schema as S
from oncallmart.models import records, risk
from oncallmart.operators import quality, silver
from oncallmart.plans import pipeline
from oncallmart.sources import bronze, fixtures, sinks, versions
from oncallmart.streaming import incremental

AT = "2026-01-02 05:00:00"


@pytest.fixture(scope="module")
def tickets(spark, small, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bronze") / "t")
    fixtures.bronze(spark, small).write.parquet(path)
    return bronze.read_bronze(spark, path)


@pytest.fixture(scope="module")
def layout(spark, tickets, tmp_path_factory):
    made = pipeline.Layout(str(tmp_path_factory.mktemp("lake")), "dev_")
    pipeline.load_silver(tickets, made, "1995-01-01")
    pipeline.export_gold(spark, made)
    return made


def test_monthly_write_round_trip(spark, tickets, tmp_path):
    made = silver.silver(tickets)
    written = sinks.write_monthly(made, str(tmp_path / "s"))
    months = sinks.verify_monthly(spark, written)
    assert written.rows == tickets.count()
    assert months.count() == made.select("Ano_Mes").distinct().count()
    # Months this small are one file each, not one per writing task.
    files = spark.read.parquet(written.path).select("Ano_Mes", F.input_file_name()).distinct()
    assert files.count() == months.count()


def test_rewriting_a_month_leaves_the_others(spark, tickets, tmp_path):
    made = silver.silver(tickets)
    path = str(tmp_path / "s")
    before = sinks.write_monthly(made, path).rows
    month = made.agg(F.max("Ano_Mes")).first()[0]
    part = sinks.write_monthly(made.where(F.col("Ano_Mes") == month), path).rows
    assert 0 < part < before and spark.read.parquet(path).count() == before


def test_mismatch_is_reported(spark, tickets, tmp_path):
    written = sinks.write_monthly(silver.silver(tickets), str(tmp_path / "s"))
    with pytest.raises(sinks.LoadMismatch):
        sinks.verify_monthly(spark, sinks.Written(written.path, written.rows + 1, written.months))


def test_loads_with_moving_start_dates(spark, tickets, tmp_path):
    layout = pipeline.Layout(str(tmp_path))
    first = pipeline.load_silver(tickets, layout, "1996-01-01").count()
    pipeline.load_silver(tickets, layout, "1998-03-01")
    again = pipeline.load_silver(tickets, layout, "1998-03-01").count()
    assert again == first == tickets.where("Aberto >= date '1996-01-01'").count()


def test_a_start_inside_a_month_keeps_its_first_days(spark, tickets, tmp_path):
    layout = pipeline.Layout(str(tmp_path))
    first = pipeline.load_silver(tickets, layout, "1996-01-01").count()
    again = pipeline.load_silver(tickets, layout, "1998-03-15")
    assert again.count() == first
    march = again.where("Ano_Mes = '1998-03'")
    assert march.count() == silver.silver(tickets).where("Ano_Mes = '1998-03'").count()


def test_run_records_are_replaced_by_a_rerun(spark, tmp_path):
    path = str(tmp_path / "records")
    for run_id, value in (("r1", 0.5), ("r2", 0.4), ("r2", 0.3)):
        rows = records.record(risk.metric_rows(spark, {"mape": value}), run_id, "forecast_d1", AT)
        sinks.write_run(rows, path)
    found = {r["run_id"]: r["value"] for r in spark.read.parquet(path).collect()}
    assert found == {"r1": 0.5, "r2": 0.3} and spark.read.parquet(path).count() == 2


def test_publish_is_repeatable(spark, tickets, tmp_path):
    path = str(tmp_path / "serving")
    sinks.publish(tickets, path, AT)
    again = sinks.publish(tickets, path, AT)
    loaded = versions.read(spark, path)
    assert sinks.verify(spark, again) and loaded.count() == again.rows == tickets.count()
    assert loaded.select("loaded_at", "updated_at").distinct().count() == 1


def test_one_broken_table_does_not_stop_the_export(spark, tmp_path):
    def broken():
        raise ValueError("no such table")

    tables = {"bad": broken, "good": lambda: spark.range(3).toDF("x")}
    with pytest.raises(sinks.ExportFailed, match="bad"):
        sinks.export_all(tables, lambda name: str(tmp_path / name))
    assert spark.read.parquet(str(tmp_path / "good")).count() == 3


def test_csv_export_and_import(spark, tickets, tmp_path):
    path = str(tmp_path / "raw")
    text = tickets.select([F.col(c).cast("string").alias(h) for h, c in S.RAW_HEADERS.items()])
    text.write.option("header", True).csv(path)
    back = bronze.load_export(bronze.read_export(spark, path))
    assert back.schema.simpleString() == tickets.schema.simpleString()
    assert back.exceptAll(tickets).count() == 0 and back.count() == tickets.count()


def test_all_published_tables_are_there(spark, layout):
    names = pipeline.gold_tables(spark, layout)
    assert len(names) == 11
    for name in names:
        assert pipeline.gold(spark, layout, name).count() > 0


def test_daily_counts_add_up(spark, layout):
    daily = pipeline.gold(spark, layout, "ml_forecast_dataset").agg(F.sum("total_chamados")).first()
    assert daily[0] == pipeline.gold(spark, layout, "ml_base_features").count()


def test_declared_tests_find_the_known_gaps(spark, layout):
    broken = pipeline.check_gold(spark, layout).where("violations > 0").collect()
    found = {(r["table"], r["column"], r["rule"]) for r in broken}
    # Tickets without a group have no row in the group dimension, and the status
    # dimension repeats keys by design.
    assert found == {
        ("fct_incidents", "dim_grupo_sk", "relationships"),
        ("dim_status", "dim_status_sk", "unique"),
    }


def test_silver_can_be_read_from_a_day_on(spark, layout):
    recent = pipeline.read_silver(spark, layout, "1999-06-15")
    whole = pipeline.read_silver(spark, layout)
    assert recent.count() == whole.where("Data_Abertura >= date '1999-06-15'").count()


def test_bad_bronze_is_refused(spark, tmp_path):
    with pytest.raises(quality.CheckFailed):
        pipeline.load_silver(spark.range(3), pipeline.Layout(str(tmp_path)), "1995-01-01")


def test_models_run_and_fill_their_metrics(spark, layout):
    filled = pipeline.train_models(spark, layout, "run-1", AT, trees=5, restarts=2)
    rows = {r["modelo_tipo"]: r for r in filled.collect()}
    assert set(rows) == set(S.MODEL_KINDS)
    assert rows["ola_risk"]["auc_roc"] > 0.5 and rows["forecast_d1"]["mape"] > 0
    facts = pipeline.gold(spark, layout, "fct_incidents")

    def output(name):
        return spark.read.parquet(layout.path("models", name))

    clusters = output("fct_cluster_id")
    assert clusters.count() == pipeline.gold(spark, layout, "ml_cluster_dataset").count()
    assert clusters.join(output("dim_cluster"), "dim_cluster_sk", "left_anti").count() == 0
    assert output("fct_ola_risk").join(facts, "incident_sk", "left_anti").count() == 0
    assert output("forecast_d1_d7").count() == 7
    assert 0 < output("detected_anomalies").count()
    assert "outcome" not in output("risk_importance").columns


def test_incremental_load_equals_the_batch(spark, tickets, tmp_path):
    source = str(tmp_path / "in")
    half = F.pmod(F.xxhash64("Numero"), F.lit(2)) == 0
    for part, mode in ((tickets.where(half), "overwrite"), (tickets.where(~half), "append")):
        part.write.mode(mode).parquet(source)
        incremental.load_silver(
            incremental.bronze_stream(spark, source), str(tmp_path / "out"),
            str(tmp_path / "progress"), "1999-01-01",
        ).awaitTermination()
    batch = silver.silver(silver.since(tickets, "1999-01-01"))
    loaded = spark.read.parquet(str(tmp_path / "out")).withColumn(
        "Ano_Mes", F.col("Ano_Mes").cast("string")
    ).select(batch.columns)
    assert loaded.count() == batch.count() and loaded.exceptAll(batch).count() == 0


def test_catalog_listing(spark, small):
    registry.base(spark, small).createOrReplaceTempView("dev_ml_base_features")
    assert sinks.table_names(spark, "dev_") == ["dev_ml_base_features"]
    spark.catalog.dropTempView("dev_ml_base_features")
