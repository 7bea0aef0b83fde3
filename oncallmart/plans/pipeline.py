"""The daily run: Bronze to Silver to Gold to model outputs, written to folders."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oncallmart import schema as S
from oncallmart.models import anomalies, clusters, forecast, records, risk
from oncallmart.operators import analytics, evaluation, quality, silver, star
from oncallmart.plans import marts
from oncallmart.session import discard_settled, settle, settled
from oncallmart.sources import sinks, versions


@dataclass(frozen=True)
class Layout:
    """Folders of one environment; the prefix plays the part of a database schema."""

    root: str
    prefix: str = ""

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{self.prefix}{name}"


def load_silver(bronze: DataFrame, layout: Layout, min_date: str = S.MIN_DATE,
                work_only: bool = False) -> DataFrame:
    """Check Bronze, merge it into Silver by ticket, check the counts, return Silver.

    Tickets that the load does not bring stay, also those of a month that it begins in; a
    ticket delivered again replaces its old row, even in another month. Versions before the
    last two are deleted."""
    quality.require_schema(bronze, S.BRONZE, S.REQUIRED)
    quality.require_rows(bronze)
    recent = silver.since(bronze, min_date)
    made = silver.silver(silver.real_work(recent) if work_only else recent)
    path = layout.path("silver", "incidents")
    versions.merge(made, path)
    versions.clean(bronze.sparkSession, path)
    return read_silver(bronze.sparkSession, layout)


def read_silver(spark: SparkSession, layout: Layout, since: str | None = None) -> DataFrame:
    """Silver, optionally from a day on; whole months before it are never listed."""
    frame = versions.read(spark, layout.path("silver", "incidents"))
    if since is None:
        return frame
    return silver.since(frame.where(F.col("Ano_Mes") >= since[:7]), since)


def gold_tables(spark: SparkSession, layout: Layout) -> dict:
    """The eleven published tables, each built when its turn comes.

    The feature table is written first; the marts read the written copy, so its
    work is done once for all of them.
    """
    def tickets() -> DataFrame:
        return read_silver(spark, layout)

    def features() -> DataFrame:
        return spark.read.parquet(layout.path("gold", "ml_base_features"))

    return {
        "ml_base_features": lambda: marts.base_features(tickets()),
        "ml_forecast_dataset": lambda: marts.forecast_mart(features()),
        "ml_sla_classification_dataset": lambda: marts.sla_mart(features()),
        "ml_cluster_dataset": lambda: marts.cluster_mart(features()),
        "dim_abertura": lambda: star.opening_dimension(tickets()),
        "dim_grupo": lambda: star.group_dimension(tickets()),
        "dim_prioridade": lambda: star.priority_dimension(tickets()),
        "dim_produto_categoria": lambda: star.product_dimension(tickets()),
        "dim_status": lambda: star.status_dimension(tickets()),
        "dim_tempo": lambda: star.day_dimension(tickets()),
        "fct_incidents": lambda: star.fact(tickets()),
    }


def export_gold(spark: SparkSession, layout: Layout) -> dict[str, sinks.Written]:
    return sinks.export_all(gold_tables(spark, layout), lambda name: layout.path("gold", name))


def gold(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    return spark.read.parquet(layout.path("gold", name))


def check_gold(spark: SparkSession, layout: Layout) -> DataFrame:
    """Every declared test of the published tables in one long result."""
    def table(name: str) -> DataFrame:
        return gold(spark, layout, name)

    dims = {
        d: table(d)
        for d in ("dim_abertura", "dim_grupo", "dim_prioridade", "dim_produto_categoria",
                  "dim_status", "dim_tempo")
    }
    facts = table("fct_incidents")
    return quality.union(
        [
            quality.model_tests(
                table("ml_base_features"), table("ml_forecast_dataset"),
                table("ml_sla_classification_dataset"), table("ml_cluster_dataset"),
            ),
            quality.star_unique(facts, dims),
            quality.star_not_null(facts, dims),
            quality.star_references(facts, dims),
        ]
    )


def train_models(spark: SparkSession, layout: Layout, run_id: str, at: str,
                 trees: int = 100, restarts: int = 10) -> DataFrame:
    """Fit all models on the published marts, write their outputs and facts.

    Returns the filled model-metrics fact.
    """
    def table(name: str) -> DataFrame:
        return gold(spark, layout, name)

    def out(name: str) -> str:
        return layout.path("models", name)

    facts = table("fct_incidents")
    daily = table("ml_forecast_dataset")

    sinks.write_output(forecast.forecast_global(daily), out("forecast_d1_d7"), csv=True)
    ahead = forecast.backtest_global(daily)
    by_priority = table("ml_base_features").groupBy(
        "prioridade_num", F.col("data_abertura").alias("ds")
    ).agg(F.count("*").alias("y"))
    sinks.write_output(
        records.forecast_fact(forecast.forecast_groups(by_priority, "prioridade_num", min_days=1)),
        out("fct_previsoes"),
    )
    teams = analytics.team_daily(table("ml_base_features"))
    sinks.write_output(
        forecast.group_errors(forecast.holdout_by_group(teams)), out("forecast_by_team"), csv=True
    )

    ready = risk.prepare(table("ml_sla_classification_dataset"))
    scores = settle(risk.score(risk.fit(ready.train, trees=trees), ready.test))
    sinks.write_output(records.risk_fact(scores, facts), out("fct_ola_risk"))
    sinks.write_output(risk.alerts(scores), out("risk_alerts"))
    sinks.write_output(risk.linear_shap(ready), out("risk_importance"), csv=True)
    sinks.write_output(evaluation.confusion(scores, "y_real", "y_pred"), out("risk_confusion"))

    grouped = clusters.run(table("ml_cluster_dataset"), restarts=restarts)
    sinks.write_output(records.cluster_fact(grouped.assignments, facts), out("fct_cluster_id"))
    profile = evaluation.cluster_profile(
        table("ml_cluster_dataset").join(grouped.assignments, "incident_id"),
        "cluster_label", S.EFFECT_COLUMNS,
    )
    sinks.write_output(records.cluster_dimension(profile), out("dim_cluster"))
    sinks.write_output(
        evaluation.cluster_balance(grouped.assignments, "cluster_label"),
        out("cluster_distribution"), csv=True,
    )

    detected = settle(anomalies.detect(table("ml_cluster_dataset")))
    sinks.write_output(detected.where(F.col("anomaly") == -1), out("detected_anomalies"), csv=True)
    sinks.write_output(anomalies.summary(detected), out("anomaly_summary"), csv=True)

    measured = {
        **forecast.horizon_records(ahead),
        "ola_risk": {"auc_roc": risk.auc_of(scores), "amostras": scores.count()},
        "clustering": {"amostras": grouped.clean_rows + grouped.outlier_rows},
    }
    parts = [
        records.record(risk.metric_rows(spark, values), run_id, model, at)
        for model, values in measured.items()
    ]
    parts.append(records.record(clusters.quality(grouped), run_id, "clustering", at))
    sinks.write_run(quality.union(parts), out("run_records"))

    sinks.write_output(records.model_dimension(daily), out("dim_modelo"))
    filled = records.metrics_fact(
        records.metrics_skeleton(read_silver(spark, layout)),
        spark.read.schema(records.RECORD).parquet(out("run_records")),
    )
    sinks.write_output(filled, out("fct_model_metrics"))
    return spark.read.parquet(out("fct_model_metrics"))


def run(bronze: DataFrame, layout: Layout, min_date: str, run_id: str, at: str,
        **training) -> DataFrame:
    """The whole day: Silver, Gold, checks, models. Returns the violated rules.

    Stored intermediate copies of the session are deleted at the end.
    """
    spark = bronze.sparkSession
    before = settled(spark)
    load_silver(bronze, layout, min_date)
    export_gold(spark, layout)
    checks = check_gold(spark, layout)
    sinks.write_output(checks, layout.path("gold", "quality_results"))
    train_models(spark, layout, run_id, at, **training)
    discard_settled(spark, keep=before)
    return spark.read.parquet(layout.path("gold", "quality_results")).where(
        F.col("violations") > 0
    )
