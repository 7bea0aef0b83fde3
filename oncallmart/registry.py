"""Every query by name: (session, folder of test tables) -> DataFrame."""

from collections.abc import Callable
from functools import wraps

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oncallmart import schema as S
from oncallmart import session
from oncallmart.functions import calendar as C
from oncallmart.functions import tickets as X
from oncallmart.models import anomalies as AN
from oncallmart.models import breaks as BR
from oncallmart.models import clusters as CL
from oncallmart.models import forecast as FC
from oncallmart.models import records as REC
from oncallmart.models import risk as RK
from oncallmart.operators import analytics as A
from oncallmart.operators import calendar_tables as K
from oncallmart.operators import evaluation as E
from oncallmart.operators import hierarchy as HY
from oncallmart.operators import ordered as O
from oncallmart.operators import prep as P
from oncallmart.operators import quality as Q
from oncallmart.operators import series as R
from oncallmart.operators import silver as SV
from oncallmart.operators import star
from oncallmart.plans import marts
from oncallmart.session import scratch, settle
from oncallmart.sources import bronze as B
from oncallmart.sources import fixtures, sinks
from oncallmart.sources import versions as VS
from oncallmart.streaming import hourly as HO
from oncallmart.streaming import sla_clock as CK

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    @wraps(function)
    def tuned(spark: SparkSession, folder: str) -> DataFrame:
        return function(session.tune(spark), folder)

    QUERIES[function.__name__] = tuned
    return function


def tickets(spark: SparkSession, folder: str) -> DataFrame:
    """Silver for every ticket of the test tables."""
    return SV.silver(fixtures.bronze(spark, folder))


def base(spark: SparkSession, folder: str) -> DataFrame:
    return marts.base_features(tickets(spark, folder))


# Columns of the feature table that no mart uses; left out of stored copies.
FREE_TEXT = [
    "incidente_pai", "aberto_por", "prioridade", "item_configuracao", "status", "entrou_kpi",
    "kpi_violado",
]


# --- Bronze and Silver --------------------------------------------------------


@query
def bronze_tickets(spark, folder):
    return fixtures.bronze(spark, folder)


@query
def headers_normalised(spark, folder):
    return B.load_export(fixtures.raw_export(spark, folder))


@query
def text_columns(spark, folder):
    return B.as_text(fixtures.bronze(spark, folder))


@query
def lost_cells(spark, folder):
    return B.lost_cells(fixtures.raw_export(spark, folder))


@query
def silver_canonical(spark, folder):
    return SV.canonical_silver(fixtures.bronze(spark, folder), fixtures.MIN_DATE)


@query
def silver_job_profile(spark, folder):
    return SV.since(SV.silver(fixtures.bronze(spark, folder), "job"), fixtures.MIN_DATE)


def _target_counts(silver: DataFrame) -> DataFrame:
    return silver.groupBy(
        F.col("Target_Risco_SLA").alias("target"),
        F.col("Prioridade_Num").alias("prioridade_num"),
        F.col("KPI_Status_Int").alias("kpi_status_int"),
    ).agg(F.count("*").alias("tickets"))


@query
def target_layered(spark, folder):
    return _target_counts(tickets(spark, folder))


@query
def target_or(spark, folder):
    return _target_counts(SV.silver(fixtures.bronze(spark, folder), "job"))


@query
def null_fill(spark, folder):
    return SV.fill_nulls(fixtures.bronze(spark, folder)).select("Numero", *S.FILL_RULES)


@query
def null_fill_explore(spark, folder):
    filled = SV.fill_nulls(fixtures.bronze(spark, folder), S.EXPLORE_FILL_RULES)
    return filled.select("Numero", *S.EXPLORE_FILL_RULES)


@query
def kpi_text_clean(spark, folder):
    text = F.col("KPI_Violado")
    return (
        fixtures.bronze(spark, folder)
        .groupBy(text.alias("kpi_violado"), X.kpi_status_cleaned(text).alias("kpi_status_int"))
        .agg(F.count("*").alias("tickets"))
    )


@query
def silver_two_loads(spark, folder):
    """Months of Silver after a load up to March 1998 and one from the middle of that month
    on, which brings a seventh of its tickets with a longer duration, and old tickets again
    with a day of opening forty days later."""
    delivered = fixtures.bronze(spark, folder)
    number = F.substring("Numero", 4, 9).cast("long")
    opened = F.col("Aberto")
    from_march = opened >= F.lit("1998-03-15").cast("timestamp_ntz")
    later = delivered.where(from_march | (number % 101 == 0)).withColumns({
        "Duracao": F.when(number % 7 == 0, F.col("Duracao") + 60).otherwise(F.col("Duracao")),
        "Aberto": F.when(from_march, opened).otherwise(opened + F.expr("INTERVAL 40 DAYS")),
    })
    path = scratch(spark, "silver")
    VS.merge(SV.silver(delivered.where(opened < F.lit("1998-04-01").cast("timestamp_ntz"))), path)
    VS.merge(SV.silver(later), path)
    return VS.read(spark, path).groupBy("Ano_Mes").agg(
        F.count("*").alias("tickets"), F.count_distinct("Numero").alias("numbers"),
        F.sum("Duracao").alias("seconds"),
    )


# --- Feature table and marts --------------------------------------------------


@query
def base_features(spark, folder):
    return base(spark, folder)


@query
def mart_daily(spark, folder):
    return marts.forecast_mart(base(spark, folder)).orderBy("data_abertura")


@query
def mart_sla(spark, folder):
    return marts.sla_mart(base(spark, folder))


@query
def mart_cluster(spark, folder):
    return marts.cluster_mart(base(spark, folder))


# --- Star schema ----------------------------------------------------------------


@query
def dim_abertura(spark, folder):
    return star.opening_dimension(tickets(spark, folder))


@query
def dim_grupo(spark, folder):
    return star.group_dimension(tickets(spark, folder))


@query
def dim_prioridade(spark, folder):
    return star.priority_dimension(tickets(spark, folder))


@query
def dim_produto_categoria(spark, folder):
    return star.product_dimension(tickets(spark, folder))


@query
def dim_status(spark, folder):
    return star.status_dimension(tickets(spark, folder))


@query
def dim_tempo(spark, folder):
    return star.day_dimension(tickets(spark, folder))


@query
def fct_incidents(spark, folder):
    return star.fact(tickets(spark, folder))


@query
def star_join(spark, folder):
    silver = settle(tickets(spark, folder).select(*star.FACT_SOURCES))
    return star.star_join(star.fact(silver), star.dimensions(silver))


@query
def status_join_unique(spark, folder):
    silver = tickets(spark, folder)
    # Counts per key first: the join then moves a handful of rows.
    facts = star.fact_keys(silver).groupBy("dim_status_sk").agg(
        F.count("*").alias("tickets"), F.count_distinct("incident_sk").alias("incidents")
    )
    status = star.joinable(star.dimensions(silver))["dim_status"]
    return (
        facts.join(status, "dim_status_sk")
        .groupBy("status", "codigo_fechamento", "entrou_kpi")
        .agg(F.sum("tickets").alias("tickets"), F.sum("incidents").alias("incidents"))
    )


# --- Calendars --------------------------------------------------------------------


@query
def date_parts(spark, folder):
    at = F.col("Aberto")
    return tickets(spark, folder).select(
        "Numero",
        F.hour(at).alias("hora"), C.day_of_week(at).alias("dow"), F.weekofyear(at).alias("semana"),
        F.month(at).alias("mes"), F.quarter(at).alias("trimestre"), F.col("Ano_Mes").alias("ano_mes"),
        C.shift(F.hour(at)).alias("turno"),
        C.off_hours(F.hour(at)).alias("fora_horario"),
        C.weekend(at).alias("fim_de_semana"), C.weekday_name(at).alias("nome_dia"),
        C.month_name_padded(at).alias("nome_mes"),
    )


@query
def holidays(spark, folder):
    return K.holidays(K.years_of(fixtures.bronze(spark, folder), "Aberto"))


@query
def day_type(spark, folder):
    silver = tickets(spark, folder)
    table = K.holidays(K.years_of(silver, "Aberto"))
    return K.with_day_kind(silver.select("Numero", "Data_Abertura"), "Data_Abertura", table)


@query
def day_type_impact(spark, folder):
    silver = tickets(spark, folder)
    return A.day_kind_impact(silver, K.holidays(K.years_of(silver, "Aberto")))


@query
def calendar_padded(spark, folder):
    return K.padded_calendar(fixtures.bronze(spark, folder), "Aberto")


@query
def date_rollup(spark, folder):
    facts = star.fact(tickets(spark, folder))
    return K.drill_down(
        facts, "aberto_at", ["target_risco_sla", "score_risco_operacional", "duracao_segundos"]
    )


@query
def role_date_join(spark, folder):
    facts = star.fact(tickets(spark, folder))
    return K.by_date_role(
        facts, {"aberto": "aberto_at", "resolvido": "resolvido_at", "encerrado": "encerrado_at"}
    )


@query
def next_seven_days(spark, folder):
    daily = marts.forecast_mart(base(spark, folder))
    ahead = K.next_days(daily)
    return ahead.withColumn("taxa_violacao", F.round("taxa_violacao", 6))


# --- Volume, seasonality, bottlenecks, goals ---------------------------------------


@query
def daily_total_vs_real(spark, folder):
    return A.total_and_real_volume(tickets(spark, folder))


@query
def group_rate_top10(spark, folder):
    return A.group_violation_rate(SV.real_work(tickets(spark, folder)))


@query
def monthly_trend(spark, folder):
    return A.monthly_trend(SV.real_work(tickets(spark, folder)))


@query
def volume_weekday(spark, folder):
    return A.volume_by_weekday(tickets(spark, folder))


@query
def volume_hour(spark, folder):
    return A.volume_by_hour(SV.real_work(tickets(spark, folder)))


@query
def value_share(spark, folder):
    unresolved = fixtures.bronze(spark, folder).where(F.col("Resolvido").isNull())
    return A.value_shares(unresolved, ["Status", "Aberto_por", "Prioridade"])


@query
def target_share(spark, folder):
    return A.share_of_total(marts.sla_mart(base(spark, folder)), "target_risco_sla")


@query
def top_categories(spark, folder):
    return A.top_values(base(spark, folder), "subcategoria", 15)


@query
def preview(spark, folder):
    chosen = tickets(spark, folder).select("Numero", "Prioridade", "Aberto", "Status")
    return chosen.orderBy("Aberto", "Numero").limit(10)


@query
def longest_per_group(spark, folder):
    chosen = base(spark, folder).select(
        "grupo_designado", "incident_id", "duracao_segundos", "prioridade_num"
    )
    return A.best_row(chosen, "grupo_designado", "duracao_segundos", "incident_id")


@query
def completeness(spark, folder):
    return A.completeness(fixtures.bronze(spark, folder))


NULLABLE = [
    "Produto", "Categoria", "Subcategoria", "Grupo_designado", "Item_de_configuracao",
    "Resolvido", "Codigo_de_fechamento", "Solucao", "Incidente_Pai", "KPI_Violado",
]


@query
def nullity_corr(spark, folder):
    return A.nullity_correlations(fixtures.bronze(spark, folder), NULLABLE)


CAUSE_NUMBERS = [
    "prioridade_num", "hora_abertura", "dia_semana_num", "fora_horario_comercial",
    "abriu_fim_de_semana", "mes_abertura", "trimestre", "possui_pai", "triagem_incompleta",
]


@query
def numeric_corr(spark, folder):
    return A.correlations(marts.cluster_mart(base(spark, folder)), CAUSE_NUMBERS)


@query
def duration_summary(spark, folder):
    work = base(spark, folder).select("duracao_horas", "horas_ate_resolucao")
    cut = O.quantiles(
        work, ["duracao_horas", "horas_ate_resolucao"], {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    )
    ends = O.melt(work, ["duracao_horas", "horas_ate_resolucao"]).groupBy("column").agg(
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.round(F.avg("value"), 6).alias("mean"), F.count("*").alias("n"),
    )
    return cut.join(ends, "column").select(
        "column", "n", "min", "max", "mean",
        *[F.round(p, 6).alias(p) for p in ("p25", "p50", "p75")],
    )


@query
def series_summary(spark, folder):
    daily = marts.forecast_mart(base(spark, folder))
    return daily.agg(
        F.min("data_abertura").alias("primeira_data"), F.max("data_abertura").alias("ultima_data"),
        F.count_distinct("data_abertura").alias("dias"),
        F.sum("total_chamados").alias("chamados"), F.sum("total_violacoes_sla").alias("violacoes"),
    )


@query
def ticket_summary(spark, folder):
    return A.summary(tickets(spark, folder), "Numero", "Aberto")


@query
def load_profile(spark, folder):
    return Q.load_profile(tickets(spark, folder))


@query
def filtered_counts(spark, folder):
    return A.filtered_counts(tickets(spark, folder))


@query
def cardinality(spark, folder):
    return A.cardinality(
        marts.cluster_mart(base(spark, folder)),
        ["grupo_designado", "categoria", "subcategoria", "produto", "turno_abertura"],
    )


@query
def resolution_rate(spark, folder):
    return A.group_rate(labelled(spark, folder), "cluster_label", "excedeu_tempo_esperado")


@query
def grid_pivot(spark, folder):
    shifts = ["Manha", "Tarde", "Noite", "Madrugada"]
    return A.pivot_max(
        base(spark, folder), "prioridade_num", "turno_abertura", "duracao_horas", shifts
    )


@query
def goal_tracking(spark, folder):
    return A.goal_tracking(tickets(spark, folder))


@query
def root_children(spark, folder):
    """Tickets below each root, by depth. Beside the tickets' own parents, a quarter hangs on
    one ticket and the others on the ticket of half their number, which may not exist."""
    number = F.substring("Numero", 4, 9).cast("long")
    above = F.when(number % 4 == 0, F.lit(1)).otherwise(F.floor(number / 2))
    named = F.when(number > 1, F.concat(F.lit("INC"), F.lpad(above.cast("string"), 9, "0")))
    linked = tickets(spark, folder).select("Numero", "Exige_Intervencao", "Possui_Pai", "Incidente_Pai")
    parent = F.when(F.col("Possui_Pai") == 1, F.col("Incidente_Pai")).otherwise(named)
    return HY.descendants(linked.withColumn("Incidente_Pai", parent))


@query
def parent_children(spark, folder):
    return A.parent_children(tickets(spark, folder))


@query
def histogram(spark, folder):
    return A.histogram(base(spark, folder), "duracao_segundos", 30)


@query
def histogram_by_class(spark, folder):
    return A.histogram(
        base(spark, folder), "duracao_segundos", 50, ["excedeu_tempo_esperado"]
    )


@query
def boxplot_stats(spark, folder):
    return E.box_plot(
        settle(labelled(spark, folder).select("cluster_label", "horas_ate_resolucao")),
        "horas_ate_resolucao", "cluster_label",
    )


@query
def drift_psi(spark, folder):
    features = ["score_risco_operacional", "hora_abertura", "grupo_designado"]
    work = settle(base(spark, folder).select("data_abertura", *features))
    edge = F.lit(fixtures.MIN_DATE).cast("date")
    marked = work.withColumn("late", F.col("data_abertura") >= edge)
    parts = [
        A.psi(marked, feature, "late")
        for feature in features
    ]
    return Q.union(parts)


@query
def drift_means(spark, folder):
    edge = F.lit(fixtures.MIN_DATE).cast("date")
    marked = base(spark, folder).withColumn("late", F.col("data_abertura") >= edge)
    return A.mean_shift(
        marked, ["duracao_horas", "score_risco_operacional", "prioridade_num"], "late"
    )


# --- Compliance ------------------------------------------------------------------------


@query
def compliance_audit(spark, folder):
    return A.audit(tickets(spark, folder)).groupBy("resultado").agg(
        F.count("*").alias("tickets")
    )


@query
def audit_labels(spark, folder):
    return A.audit(tickets(spark, folder)).select("Numero", "resultado")


@query
def weekend_crossing(spark, folder):
    return A.weekend_crossing(A.audit(tickets(spark, folder)))


@query
def business_hours(spark, folder):
    return A.clock_comparison(A.audit(tickets(spark, folder)))


@query
def business_days(spark, folder):
    days = C.business_days(F.to_date("Aberto"), F.to_date("Encerrado"))
    return tickets(spark, folder).select("Numero", days.cast("bigint").alias("dias_uteis"))


# --- Data quality -------------------------------------------------------------------------


@query
def quality_unique(spark, folder):
    silver = settle(tickets(spark, folder).select(*star.KEY_SOURCES))
    return Q.star_unique(star.fact_keys(silver), star.dimensions(silver))


@query
def quality_not_null(spark, folder):
    chosen = dict.fromkeys([*Q.CRITICAL, *star.KEY_SOURCES])
    silver = settle(tickets(spark, folder).select(*chosen))
    # The keys are never null, because they are made of stand-ins; what they are made of may be.
    sources = Q.row_rules("silver_keys", silver, [Q.not_null(c) for c in star.KEY_SOURCES])
    return Q.union(
        [
            Q.silver_not_null(silver),
            Q.star_not_null(star.fact_keys(silver), star.dimensions(silver)),
            sources,
        ]
    )


@query
def quality_models(spark, folder):
    work = settle(base(spark, folder).drop(*FREE_TEXT))
    return Q.model_tests(
        work, marts.forecast_mart(work), marts.sla_mart(work), marts.cluster_mart(work)
    )


@query
def quality_accepted(spark, folder):
    labels = fixtures.table(spark, folder, "labels")
    return Q.row_rules(
        "labels", labels, [Q.accepted("quality", [0, 1]), Q.accepted("toxic", [0, 1])]
    ).unionByName(
        Q.row_rules(
            "bronze", fixtures.bronze(spark, folder),
            [Q.accepted("Status", ["Encerrado", "Resolvido"]), Q.accepted("KPI_Violado", ["NAO"])],
        )
    )


@query
def quality_orphans(spark, folder):
    silver = settle(tickets(spark, folder).select(*star.KEY_SOURCES))
    return Q.star_references(star.fact_keys(silver), star.dimensions(silver))


@query
def quality_ranges(spark, folder):
    return Q.silver_ranges(tickets(spark, folder))


@query
def quality_job_ranges(spark, folder):
    return Q.silver_ranges(SV.silver(fixtures.bronze(spark, folder), "job"))


@query
def table_counts_union(spark, folder):
    work = settle(base(spark, folder).drop(*FREE_TEXT))
    return Q.table_counts(
        {
            "ml_base_features": work,
            "ml_sla_classification_dataset": marts.sla_mart(work),
            "ml_cluster_dataset": marts.cluster_mart(work),
            "ml_forecast_dataset": marts.forecast_mart(work),
        }
    )


@query
def scalar_checks(spark, folder):
    work = settle(base(spark, folder).drop(*FREE_TEXT))
    return Q.key_checks(
        work, marts.forecast_mart(work), marts.sla_mart(work), marts.cluster_mart(work)
    )


@query
def class_balance(spark, folder):
    return P.class_balance(tickets(spark, folder), "Target_Risco_SLA")


@query
def complete_rows(spark, folder):
    chosen = fixtures.bronze(spark, folder).select("Numero", "Resolvido", "KPI_Violado")
    return chosen.na.drop(subset=["Resolvido", "KPI_Violado"])


# --- Series ------------------------------------------------------------------------------


@query
def team_daily(spark, folder):
    return A.team_daily(base(spark, folder))


@query
def lags_rolling(spark, folder):
    return R.lags(R.fill_days(A.team_daily(base(spark, folder))))


@query
def holdout_split(spark, folder):
    return R.with_holdout(R.long_enough(A.team_daily(base(spark, folder)))).select(
        "team", "ds", "y", "is_test"
    )


def global_daily(spark, folder):
    daily = marts.forecast_mart(base(spark, folder))
    return daily.select(
        F.lit("all").alias("team"), F.col("data_abertura").alias("ds"),
        F.col("total_chamados").alias("y"),
    )


@query
def backtest_folds(spark, folder):
    teams = R.long_enough(A.team_daily(base(spark, folder))).select("team", "ds", "y")
    # Daily rows of a few series: small next to the tickets, and read three times.
    return R.fold_sizes(settle(teams.unionByName(global_daily(spark, folder))))


@query
def seasonal_naive(spark, folder):
    teams = R.long_enough(A.team_daily(base(spark, folder))).select("team", "ds", "y")
    return R.naive_forecasts(R.with_holdout(teams))


@query
def forecast_errors(spark, folder):
    teams = R.long_enough(A.team_daily(base(spark, folder))).select("team", "ds", "y")
    made = R.naive_forecasts(R.with_holdout(teams))
    return R.error_metrics(made, "y", "weekday_mean", ["team"])


@query
def horizon_errors(spark, folder):
    filled = R.fill_days(global_daily(spark, folder))
    return R.horizon_metrics(R.naive_backtest(filled))


@query
def mean_impute(spark, folder):
    daily = marts.forecast_mart(base(spark, folder)).select(
        "data_abertura",
        # Days on which every ticket is low priority have no rate to report.
        F.when(F.col("total_criticos") > 0, F.col("pct_violacao_sla")).alias("taxa"),
    )
    return R.mean_filled(daily, "taxa").withColumn("taxa", F.round("taxa", 6))


# --- Feature preparation --------------------------------------------------------------------


@query
def iqr_vote(spark, folder):
    mart = settle(base(spark, folder).select("incident_id", *P.IQR_COLUMNS))
    voted = P.iqr_votes(mart, P.iqr_fences(mart))
    return voted.select("incident_id", "outlier_votes", "is_outlier")


@query
def clean_plus_outliers(spark, folder):
    mart = settle(base(spark, folder).select("incident_id", *P.IQR_COLUMNS))
    voted = P.iqr_votes(mart, P.iqr_fences(mart), share=0.15)
    clean, outliers = P.split_outliers(voted)
    both = clean.withColumn("origem", F.lit("clean")).unionByName(
        outliers.withColumn("origem", F.lit("outlier"))
    )
    return both.groupBy("origem").agg(F.count("*").alias("tickets"))


@query
def cyclic_enc(spark, folder):
    chosen = base(spark, folder).select("incident_id", *S.CYCLES)
    made = P.cyclic(chosen)
    return made.select(
        "incident_id", *[F.round(c, 9).alias(c) for c in made.columns if c != "incident_id"]
    )


@query
def freq_enc(spark, folder):
    chosen = settle(base(spark, folder).select("incident_id", *S.FREQUENCY_COLUMNS))
    return P.frequency_encode(
        chosen, P.frequencies(chosen, S.FREQUENCY_COLUMNS), S.FREQUENCY_COLUMNS
    )


@query
def onehot_levels(spark, folder):
    return P.one_hot_levels(base(spark, folder), ["categoria", "turno_abertura", "subcategoria"])


@query
def standardise(spark, folder):
    chosen = base(spark, folder).select("incident_id", *CAUSE_NUMBERS)
    made = P.standardise(chosen, CAUSE_NUMBERS)
    return made.select("incident_id", *[F.round(c, 6).alias(c) for c in CAUSE_NUMBERS])


@query
def minmax(spark, folder):
    chosen = P.split_of(base(spark, folder).select("incident_id", "duracao_segundos", "hora_abertura"))
    train = chosen.withColumn("is_train", ~F.col("is_test"))
    return P.min_max(train, ["duracao_segundos", "hora_abertura"], "is_train").select(
        "incident_id", "duracao_segundos", "hora_abertura"
    )


@query
def numeric_fill(spark, folder):
    silver = tickets(spark, folder)
    hours = X.hours_between(F.col("Aberto"), F.col("Resolvido")).alias("horas")
    return P.zero_filled(silver.select("Numero", hours), ["horas"])


@query
def hash_split(spark, folder):
    return P.split_of(base(spark, folder).select("incident_id"))


@query
def stratified_split(spark, folder):
    chosen = base(spark, folder).select("incident_id", "excedeu_tempo_esperado")
    return P.exact_stratified_split(chosen, "excedeu_tempo_esperado")


@query
def class_weights(spark, folder):
    return P.class_weights(base(spark, folder), "excedeu_tempo_esperado")


@query
def zscore_flags(spark, folder):
    return P.sigma_flags(
        settle(base(spark, folder).select("incident_id", "duracao_horas")),
        "duracao_horas", "incident_id",
    )


# --- Evaluation on a score that follows from the data ----------------------------------------


def scored(spark, folder):
    """A risk score from the composite score and the time of day, and the label."""
    at = F.col("aberto_at")
    seconds = F.hour(at) * 3600 + F.minute(at) * 60 + F.second(at)
    score = (F.col("score_risco_operacional") * 86400 + seconds.cast("int")) / F.lit(777600.0)
    return base(spark, folder).select(
        "incident_id", "grupo_designado", F.col("excedeu_tempo_esperado").alias("label"),
        score.alias("score"),
    )


@query
def pr_curve(spark, folder):
    return E.pr_curve(scored(spark, folder), "label", "score")


@query
def pr_threshold(spark, folder):
    return E.best_threshold(E.pr_curve(scored(spark, folder), "label", "score"))


@query
def roc_curve(spark, folder):
    return E.roc_curve(scored(spark, folder), "label", "score")


@query
def roc_auc(spark, folder):
    return E.auc(scored(spark, folder), "label", "score")


@query
def roc_auc_by_group(spark, folder):
    return E.auc(scored(spark, folder), "label", "score", ["grupo_designado"])


@query
def confusion(spark, folder):
    flagged = scored(spark, folder).withColumn("flagged", (F.col("score") > 0.5).cast("int"))
    return E.confusion(flagged, "label", "flagged")


@query
def alerts(spark, folder):
    return scored(spark, folder).where(F.col("score") > 0.8)


def labelled(spark, folder):
    """Tickets with a label A..D that follows from their priority."""
    letters = F.array(*[F.lit(v) for v in S.CLUSTER_LABELS.values()])
    return marts.cluster_mart(base(spark, folder)).withColumn(
        "cluster_label", F.element_at(letters, F.col("prioridade_num") % 4 + 1)
    )


@query
def cluster_profile(spark, folder):
    return E.cluster_profile(labelled(spark, folder), "cluster_label", S.EFFECT_COLUMNS)


@query
def cluster_stats(spark, folder):
    return E.cluster_stats(labelled(spark, folder), "cluster_label", S.EFFECT_COLUMNS)


@query
def cluster_balance(spark, folder):
    return E.cluster_balance(labelled(spark, folder), "cluster_label")


@query
def effect_join(spark, folder):
    mart = settle(
        labelled(spark, folder).select("incident_id", "cluster_label", *S.EFFECT_COLUMNS)
    )
    assigned = mart.select("incident_id", "cluster_label")
    return A.with_effects(assigned, mart)


@query
def status_join_fanout(spark, folder):
    """The raw many-to-many join: a ticket appears once per row of its status key."""
    silver = tickets(spark, folder)
    facts = star.fact_keys(silver).groupBy("dim_status_sk").agg(F.count("*").alias("n"))
    joined = facts.join(star.status_dimension(silver), "dim_status_sk")
    return joined.groupBy("status", "codigo_fechamento", "entrou_kpi").agg(
        F.sum("n").alias("joined_rows")
    )


# --- Facts fed by model output, on the labels and scores above -------------------------------


@query
def fct_cluster_id(spark, folder):
    letters = F.array(*[F.lit(v) for v in S.CLUSTER_LABELS.values()])
    silver = settle(tickets(spark, folder))
    made = marts.base_features(silver).select(
        "incident_id", (F.col("prioridade_num") % 4).alias("cluster_pred"),
        F.element_at(letters, F.col("prioridade_num") % 4 + 1).alias("cluster_label"),
    )
    return REC.cluster_fact(made, star.fact(silver))


@query
def dim_cluster(spark, folder):
    profile = E.cluster_profile(
        labelled(spark, folder), "cluster_label", ["duracao_horas", "target_risco_sla"]
    )
    return REC.cluster_dimension(profile)


@query
def fct_ola_risk(spark, folder):
    scores = scored(spark, folder).select(
        "incident_id", F.col("label").alias("y_real"),
        (F.col("score") > 0.5).cast("int").alias("y_pred"), F.col("score").alias("y_pred_proba"),
    )
    return REC.risk_fact(scores, star.fact(tickets(spark, folder)))


# --- Models ------------------------------------------------------------------------------------


@query
def metrics_skeleton(spark, folder):
    return REC.metrics_skeleton(tickets(spark, folder))


@query
def forecast_global(spark, folder):
    return FC.forecast_global(marts.forecast_mart(base(spark, folder)))


@query
def forecast_holdout(spark, folder):
    return FC.evaluate_global(marts.forecast_mart(base(spark, folder)))


@query
def fct_model_metrics(spark, folder):
    work = settle(base(spark, folder).drop(*FREE_TEXT))
    daily = settle(marts.forecast_mart(work))
    ready = RK.prepare(marts.sla_mart(work))
    scores = settle(RK.score(RK.fit(ready.train), ready.test))
    grouped = CL.run(marts.cluster_mart(work))
    measured = {
        **FC.horizon_records(FC.backtest_global(daily)),
        "ola_risk": {"auc_roc": RK.auc_of(scores), "amostras": scores.count()},
        "clustering": {"amostras": grouped.clean_rows + grouped.outlier_rows},
    }
    runs = [
        REC.record(RK.metric_rows(spark, values), "run-1", model, "2001-08-01 05:00:00")
        for model, values in measured.items()
    ]
    # The newest day of all tickets, noise included.
    return REC.metrics_fact(REC.metrics_skeleton(tickets(spark, folder)), Q.union(runs))


@query
def dim_modelo(spark, folder):
    return REC.model_dimension(marts.forecast_mart(base(spark, folder)))


@query
def forecast_team(spark, folder):
    return FC.group_errors(FC.holdout_by_group(A.team_daily(base(spark, folder))))


@query
def forecast_rolling_origin(spark, folder):
    return R.horizon_metrics(FC.backtest_global(marts.forecast_mart(base(spark, folder))))


def _daily(spark, folder) -> DataFrame:
    return FC.daily_series(marts.forecast_mart(base(spark, folder))).withColumn("team", F.lit("all"))


@query
def trend_changes(spark, folder):
    """Changes of trend of all tickets and of every team."""
    teams = A.team_daily(base(spark, folder)).select("team", "ds", "y")
    return BR.trend_changes(teams.unionByName(_daily(spark, folder).select("team", "ds", "y")))


@query
def forecast_breaks(spark, folder):
    return BR.forecast(_daily(spark, folder), yearly=FC.YEARLY_WAVES)


@query
def breaks_backtest(spark, folder):
    """Errors of the bending trend and of the line at the same cut-offs."""
    return BR.errors(BR.backtest(_daily(spark, folder), yearly=FC.YEARLY_WAVES))


@query
def fct_previsoes(spark, folder):
    daily = base(spark, folder).groupBy("prioridade_num", F.col("data_abertura").alias("ds")).agg(
        F.count("*").alias("y")
    )
    return REC.forecast_fact(FC.forecast_groups(daily, "prioridade_num", min_days=1))


@query
def risk_scores(spark, folder):
    ready = RK.prepare(marts.sla_mart(base(spark, folder)))
    return RK.score(RK.fit(ready.train), ready.test)


@query
def importance(spark, folder):
    return RK.linear_shap(RK.prepare(marts.sla_mart(base(spark, folder))))


@query
def permutation_importance(spark, folder):
    ready = RK.prepare(marts.sla_mart(base(spark, folder)))
    return RK.permutation_importance(RK.fit(ready.train), ready.test, ready.encoder.names())


@query
def tree_importance(spark, folder):
    """Mean absolute contribution of each feature to the trees' margin."""
    ready = RK.prepare(marts.sla_mart(base(spark, folder)))
    return RK.tree_importance(RK.fit(ready.train), ready.test, ready.encoder.names())


@query
def contribution_check(spark, folder):
    """Test tickets by class, and those whose contributions add up to the model's margin."""
    ready = RK.prepare(marts.sla_mart(base(spark, folder)))
    made = RK.tree_contributions(RK.fit(ready.train, trees=20), ready.test)
    total = F.aggregate("contributions", F.col("base"), lambda a, x: a + x)
    return made.join(ready.test.select("incident_id", "label"), "incident_id").groupBy(
        F.col("label").cast("int").alias("label")
    ).agg(
        F.count("*").alias("tickets"),
        F.count_if(F.abs(total - F.col("margin")) <= 1e-6).alias("additive"),
    )


@query
def feature_selection(spark, folder):
    return RK.selection_report(RK.prepare(marts.sla_mart(base(spark, folder))))


@query
def kmeans_assign(spark, folder):
    made = CL.run(marts.cluster_mart(base(spark, folder)))
    return made.assignments.select("incident_id", "cluster_pred", "cluster_label")


@query
def pca_projection(spark, folder):
    mart = settle(marts.cluster_mart(base(spark, folder)))
    xy = vector_to_array("features")
    return CL.fit_features(mart).apply(mart).select(
        "incident_id", F.get(xy, F.lit(0)).alias("pc1"), F.get(xy, F.lit(1)).alias("pc2")
    )


@query
def cluster_quality(spark, folder):
    return CL.quality(CL.run(marts.cluster_mart(base(spark, folder))))


@query
def cluster_sweep(spark, folder):
    clean = settle(marts.cluster_mart(base(spark, folder)))
    return CL.sweep(settle(CL.fit_features(clean).apply(clean)))


@query
def iso_forest(spark, folder):
    return AN.detect(marts.cluster_mart(base(spark, folder)))


@query
def iso_forest_summary(spark, folder):
    return AN.summary(settle(AN.detect(marts.cluster_mart(base(spark, folder)))))


@query
def cv_scores(spark, folder):
    ready = RK.prepare(marts.sla_mart(base(spark, folder)))
    return RK.cross_validate(RK.selected(ready).train)


@query
def cv_summary(spark, folder):
    ready = RK.prepare(marts.sla_mart(base(spark, folder)))
    return RK.cv_summary(RK.cross_validate(RK.selected(ready).train))


@query
def grid_search(spark, folder):
    """All 27 combinations of depth, rate and number of trees."""
    return RK.joint_grid_search(RK.prepare_binned(marts.sla_mart(base(spark, folder))))


@query
def grid_auc_pivot(spark, folder):
    """Best area by depth and rate, over the numbers of trees."""
    return A.pivot_max(grid_search(spark, folder), "max_depth", "learning_rate", "auc_roc", RK.GRID["stepSize"])


@query
def grid_best_per_depth(spark, folder):
    """The best combination of each depth; fewer trees win ties."""
    found = grid_search(spark, folder).withColumn("fewer", -F.col("n_estimators"))
    order = F.struct("auc_roc", "fewer", -F.col("learning_rate"))
    return found.groupBy("max_depth").agg(
        F.max_by(F.struct("learning_rate", "n_estimators", "auc_roc", "f1"), order).alias("b")
    ).select("max_depth", "b.*")


@query
def cv_selection(spark, folder):
    """Areas of each fold with all features and with those that its own training chose."""
    ready = RK.prepare_binned(marts.sla_mart(base(spark, folder)))
    return RK.cross_validate_selected(ready)[0]


@query
def cv_selection_tickets(spark, folder):
    """Tickets in each fold of the training rows."""
    ready = RK.prepare_binned(marts.sla_mart(base(spark, folder)))
    return RK.cross_validate_selected(ready, RK.trees.Plan(depth=2, trees=5))[0].select("fold", "tickets")


# --- What every run of a model must keep, whatever it learns -------------------------------------


@query
def risk_split_counts(spark, folder):
    """Tickets by split and class, after encoding."""
    ready = RK.prepare(marts.sla_mart(base(spark, folder)))
    both = ready.train.withColumn("is_test", F.lit(False)).unionByName(
        ready.test.withColumn("is_test", F.lit(True))
    )
    return both.groupBy("is_test", F.col("label").cast("int").alias("label")).agg(
        F.count("*").alias("tickets")
    )


@query
def risk_width(spark, folder):
    """Feature columns of each text column: its training levels and one for unseen ones."""
    encoder = RK.fit_encoder(marts.sla_mart(base(spark, folder)))
    levels = encoder.levels.groupBy("column").agg((F.count("*") + 1).alias("features"))
    return levels


@query
def iso_forest_counts(spark, folder):
    """Every ticket is scored, and no more than a twentieth is flagged."""
    found = AN.detect(marts.cluster_mart(base(spark, folder)))
    flagged = F.count_if(F.col("anomaly") == -1)
    return found.agg(
        F.count("*").alias("tickets"), F.count("anomaly_score").alias("scored"),
        (flagged <= F.ceil(F.count("*") * 0.05)).alias("within_share"),
    )


@query
def cluster_counts(spark, folder):
    """Every ticket has one of the four labels."""
    made = CL.run(marts.cluster_mart(base(spark, folder))).assignments
    return made.agg(
        F.count("*").alias("tickets"), F.count_distinct("incident_id").alias("incidents"),
        F.count_distinct("cluster_label").alias("labels"),
        F.count_if(F.col("cluster_label").isNull()).alias("unlabelled"),
    )


@query
def record_latest(spark, folder):
    """Latest records per month: the first run records volumes, the second the violations of
    even months; it is stored with doubled values first and then again."""
    mart = marts.forecast_mart(base(spark, folder))
    monthly = settle(mart.groupBy("ano_mes").agg(
        F.sum("total_chamados").alias("volume"), F.sum("total_violacoes_sla").alias("violations"),
    ))
    even = F.substring("ano_mes", 6, 2).cast("int") % 2 == 0

    def run(rows, value, k):
        return REC.record(
            rows.select(F.col("ano_mes").alias("metric"), value.alias("value")),
            f"run-{k}", "forecast_d1", f"2001-08-0{k} 05:00:00",
        )

    path = scratch(spark, "runs")
    sinks.write_run(run(monthly, F.col("volume"), 1), path)
    for times in (2, 1):
        sinks.write_run(run(monthly.where(even), F.col("violations") * times, 2), path)
    return REC.latest(spark.read.schema(REC.RECORD).parquet(path)).select("model", "name", "value", "at")


@query
def schema_differences(spark, folder):
    """Columns that Bronze lacks or has beyond its declaration, without and with one cut."""
    frame = fixtures.bronze(spark, folder)
    parts = []
    for source, made in (("bronze", frame), ("cut", frame.drop("Status").withColumn("extra", F.lit(1)))):
        missing, extra = Q.column_differences(made, S.BRONZE.names)
        parts.append(
            made.agg(F.count("*").alias("tickets")).select(
                F.lit(source).alias("source"), "tickets",
                F.lit(",".join(missing)).alias("missing"), F.lit(",".join(extra)).alias("extra"),
            )
        )
    return Q.union(parts)


@query
def events_hourly(spark, folder):
    """Hourly volume of events by type, loaded as a stream: published and still open windows."""
    # A pattern, since a stream does not start from the path of one file; one batch, so that
    # the order of the files decides nothing.
    events = HO.event_stream(spark, f"{folder}/events.parquet*", None)
    path, state = scratch(spark, "hourly"), scratch(spark, "hourly-state")
    HO.load_volume(events, path, state).awaitTermination()
    windows = HO.volume(spark, path).withColumn("open", F.lit(False)).unionByName(
        HO.open_volume(spark, state).withColumn("open", F.lit(True))
    )
    return windows.withColumn("hour", F.col("hour").cast("timestamp_ntz"))


@query
def sla_clock(spark, folder):
    """Tickets whose contract time ran out unresolved, by a stream of openings and resolutions."""
    records, path, state = (scratch(spark, f"sla-{kind}") for kind in ("records", "alerts", "state"))
    CK.ticket_records(fixtures.bronze(spark, folder)).write.parquet(records)
    CK.load_alerts(CK.record_stream(spark, records, None), path, state).awaitTermination()
    return CK.told(spark, path)
