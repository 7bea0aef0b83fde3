"""Volume, seasonality, bottleneck and goal analyses."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oncallmart import schema as S
from oncallmart.functions import calendar as C
from oncallmart.functions import numeric as N
from oncallmart.functions import tickets as X
from oncallmart.operators import calendar_tables


def total_and_real_volume(silver: DataFrame) -> DataFrame:
    return silver.groupBy("Data_Abertura").agg(
        F.count("Numero").alias("volume_total"),
        F.sum("Exige_Intervencao").alias("esforco_real"),
    )


def group_violation_rate(silver: DataFrame, minimum: int = 50, top: int = 10) -> DataFrame:
    """Groups with more than `minimum` tickets, worst violation rate first."""
    group = F.coalesce("Grupo_designado", F.lit("Não Classificado"))
    return (
        silver.groupBy(group.alias("grupo"))
        .agg(
            F.count("Duracao").alias("total_chamados"),
            F.sum("Target_Risco_SLA").alias("violacoes"),
        )
        .where(F.col("total_chamados") > minimum)
        .withColumn("taxa_violacao", N.percent(F.col("violacoes"), F.col("total_chamados")))
        .orderBy(F.desc("taxa_violacao"), "grupo")
        .limit(top)
    )


def monthly_trend(silver: DataFrame) -> DataFrame:
    return (
        silver.groupBy(F.col("Ano_Mes").alias("ano_mes"))
        .agg(
            F.count("Duracao").alias("total_incidentes"),
            F.sum("Target_Risco_SLA").alias("violados"),
        )
        .withColumn("taxa_violacao", N.percent(F.col("violados"), F.col("total_incidentes")))
    )


def volume_by_weekday(silver: DataFrame) -> DataFrame:
    return silver.groupBy(
        F.weekday("Aberto").alias("dia_semana_num"),
        C.weekday_name(F.col("Aberto")).alias("nome_dia"),
    ).agg(F.count("Duracao").alias("total_incidentes"))


def volume_by_hour(silver: DataFrame) -> DataFrame:
    return silver.groupBy(F.hour("Aberto").alias("hora")).agg(
        F.count("Duracao").alias("total_incidentes")
    )


def day_kind_impact(silver: DataFrame, holiday_table: DataFrame) -> DataFrame:
    """Daily counts, then days, tickets and tickets per day for each kind of day."""
    daily = silver.groupBy("Data_Abertura").agg(F.count("Duracao").alias("volume"))
    marked = calendar_tables.with_day_kind(daily, "Data_Abertura", holiday_table)
    total, days = F.col("volume_total"), F.col("dias")
    return (
        marked.groupBy("tipo_dia")
        .agg(F.count("*").alias("dias"), F.sum("volume").alias("volume_total"))
        .withColumn(
            "media_por_dia",
            F.round(total.cast("decimal(20,0)") / days.cast("decimal(20,0)"), 1).cast("double"),
        )
        .orderBy(F.desc("media_por_dia"), "tipo_dia")
    )


def value_shares(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Count and share of every value of every column, in one pass over the rows."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
          for c in columns]
    )
    counts = frame.select(F.inline(pairs)).groupBy("column", "value").agg(
        F.count("*").alias("tickets")
    )
    rows = frame.agg(F.count("*")).scalar()
    return counts.withColumn("share", F.lit(100.0) * F.col("tickets") / rows)


def share_of_total(frame: DataFrame, column: str) -> DataFrame:
    """Share of each value by a window over the handful of counted values."""
    counts = frame.groupBy(column).agg(F.count("*").alias("total_tickets"))
    whole = F.sum("total_tickets").over(Window.partitionBy())
    return counts.withColumn("percentual", N.percent_2(F.col("total_tickets"), whole))


def top_values(frame: DataFrame, column: str, n: int) -> DataFrame:
    return (
        frame.groupBy(column).agg(F.count("*").alias("tickets"))
        .orderBy(F.desc("tickets"), column).limit(n)
    )


def completeness(frame: DataFrame) -> DataFrame:
    """Nulls and filled share per column, from a single pass."""
    named = [
        F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("nulls"))
        for c in frame.columns
    ]
    return (
        frame.agg(F.array(*named).alias("c"), F.count("*").alias("tickets"))
        .select("tickets", F.inline("c"))
        .select(
            "column", "nulls", "tickets",
            (F.lit(100.0) * (F.col("tickets") - F.col("nulls")) / F.col("tickets")).alias("filled"),
        )
    )


def correlations(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, from a single pass."""
    pairs = [
        F.struct(
            F.lit(a).alias("a"), F.lit(b).alias("b"),
            F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias("r"),
        )
        for i, a in enumerate(columns)
        for b in columns[i + 1:]
    ]
    return frame.agg(F.array(*pairs).alias("p")).select(F.inline("p")).select(
        "a", "b", F.round("r", 6).alias("r")
    )


def nullity_correlations(frame: DataFrame, columns: list[str]) -> DataFrame:
    nulls = frame.select([F.col(c).isNull().cast("double").alias(c) for c in columns])
    return correlations(nulls, columns)


def summary(frame: DataFrame, key: str, at: str) -> DataFrame:
    return frame.agg(
        F.count("*").alias("total"),
        F.count_distinct(key).alias("distinct_keys"),
        F.min(at).alias("first_at"),
        F.max(at).alias("last_at"),
    )


def filtered_counts(frame: DataFrame) -> DataFrame:
    return frame.agg(
        F.count_if(F.col("Numero").isNull()).alias("null_numero"),
        F.count_if(F.col("Data_Abertura").isNull()).alias("null_data"),
        F.count_if(F.col("Resolvido").isNull()).alias("null_resolvido"),
        F.count_if(F.col("Grupo_designado").isNull()).alias("null_grupo"),
    )


def cardinality(frame: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """Distinct values per column; the approximate form needs no shuffle of values."""
    if approximate:
        counted = [
            F.struct(F.lit(c).alias("column"), F.approx_count_distinct(c).alias("distinct_values"))
            for c in columns
        ]
        return frame.agg(F.array(*counted).alias("c")).select(F.inline("c"))
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
          for c in columns]
    )
    distinct = frame.select(F.inline(pairs)).distinct()
    return distinct.groupBy("column").agg(F.count("value").alias("distinct_values"))


def group_rate(frame: DataFrame, group: str, indicator: str) -> DataFrame:
    return frame.groupBy(group).agg(
        F.count("*").alias("tickets"),
        N.percent(F.sum(indicator), F.count("*")).alias("rate"),
    )


def pivot_max(frame: DataFrame, row: str, column: str, value: str, columns: list) -> DataFrame:
    """Best value per pair; the listed columns spare a pass to find them."""
    return frame.groupBy(row).pivot(column, columns).agg(F.max(value))


def best_row(frame: DataFrame, by: str, value: str, tiebreak: str) -> DataFrame:
    """The row with the highest value of each group, without sorting the group."""
    order = F.struct(F.col(value), F.col(tiebreak))
    rest = F.struct(*[c for c in frame.columns if c != by])
    return frame.groupBy(by).agg(F.max_by(rest, order).alias("r")).select(by, "r.*")


def team_daily(base: DataFrame) -> DataFrame:
    """Tickets per team and day."""
    return (
        base.where(F.col("grupo_designado").isNotNull())
        .groupBy(F.col("grupo_designado").alias("team"), F.col("data_abertura").alias("ds"))
        .agg(F.count("*").alias("y"))
    )


def goal_tracking(silver: DataFrame) -> DataFrame:
    """Tickets and violations per year against the annual goals of each priority.

    The last year is projected to its end at the pace seen up to its last day.
    """
    spark = silver.sparkSession
    goals = spark.createDataFrame(
        S.ANNUAL_GOALS,
        "prioridade_num int, viol_min int, viol_max int, vol_min int, vol_max int",
    )
    yearly = (
        silver.where(F.col("Prioridade_Num").isin([g[0] for g in S.ANNUAL_GOALS]))
        .groupBy(F.year("Data_Abertura").alias("ano"),
                 F.col("Prioridade_Num").alias("prioridade_num"))
        .agg(
            F.count("*").alias("chamados"),
            F.sum("Target_Risco_SLA").alias("violacoes"),
        )
    )
    last_day = silver.agg(F.max("Data_Abertura")).scalar()
    start = F.make_date(F.col("ano"), F.lit(1), F.lit(1))
    end = F.make_date(F.col("ano"), F.lit(12), F.lit(31))
    days = F.date_diff(end, start) + 1
    seen = F.date_diff(F.least(end, last_day), start) + 1

    def place(value, low, high):
        return F.when(value < F.col(low), "abaixo").when(value > F.col(high), "acima").otherwise(
            "dentro"
        )

    return yearly.join(F.broadcast(goals), "prioridade_num").select(
        "ano", "prioridade_num", "chamados", "violacoes",
        place(F.col("violacoes"), "viol_min", "viol_max").alias("meta_violacoes"),
        place(F.col("chamados"), "vol_min", "vol_max").alias("meta_volume"),
        (F.col("violacoes") * days / seen).alias("violacoes_projetadas"),
        (F.col("chamados") * days / seen).alias("chamados_projetados"),
    )


def parent_children(silver: DataFrame) -> DataFrame:
    """Children per parent ticket, with the parent's own status.

    Children are counted before the join, so one parent of a third of all tickets
    costs one row in the shuffle.
    """
    children = (
        silver.where(F.col("Possui_Pai") == 1)
        .groupBy(F.col("Incidente_Pai").alias("parent_id"))
        .agg(
            F.count("*").alias("children"),
            F.sum("Exige_Intervencao").alias("children_with_work"),
        )
    )
    parents = silver.select(
        F.col("Numero").alias("parent_id"), F.col("Status").alias("parent_status"),
        F.col("Prioridade_Num").alias("parent_priority"),
    )
    return children.join(parents, "parent_id", "left")


def histogram(frame: DataFrame, column: str, bins: int, by: list[str] = ()) -> DataFrame:
    """Equal-width bins between the overall minimum and maximum; the last is closed.

    A column with one value falls into the middle bin.
    """
    value = F.col(column).cast("double")
    limits = frame.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    placed = frame.where(value.isNotNull()).withColumn("_l", limits)
    low, high = F.col("_l.lo"), F.col("_l.hi")
    position = F.floor((value - low) * bins / F.nullif(high - low, F.lit(0.0)))
    index = F.least(F.coalesce(position, F.lit(bins // 2)), F.lit(bins - 1)).cast("int")
    return placed.groupBy(*by, index.alias("bin")).agg(F.count("*").alias("tickets"))


def audit(silver: DataFrame) -> DataFrame:
    """Each ticket that needed work, with its compliance label."""
    label = X.audit_label(
        F.col("Prioridade_Num"), F.col("Duracao_Horas"), F.col("KPI_Status_Int"),
        F.col("Possui_Pai"), F.col("Status"),
    )
    return silver.where(F.col("Exige_Intervencao") == 1).withColumn("resultado", label)


def weekend_crossing(audited: DataFrame) -> DataFrame:
    """How many tickets of each label ran over a weekend."""
    crossed = C.crosses_weekend(F.col("Aberto"), F.col("Encerrado"))
    return audited.groupBy("resultado").agg(
        F.count("*").alias("tickets"),
        F.sum(crossed).alias("crossed"),
        N.percent(F.sum(crossed), F.count("*")).alias("pct_crossed"),
    )


def clock_comparison(audited: DataFrame) -> DataFrame:
    """Mean calendar hours against mean business hours (weekdays x 8) per label."""
    micros = F.timestamp_diff("MICROSECOND", F.col("Aberto"), F.col("Encerrado"))
    days = C.business_days(F.to_date("Aberto"), F.to_date("Encerrado"))
    n = F.count("*")
    return audited.groupBy("resultado").agg(
        n.alias("tickets"),
        (F.sum(micros) / F.lit(3.6e9) / n).alias("horas_24x7"),
        (F.sum(days) * 8 / n).alias("horas_8x5"),
    )


def psi(frame: DataFrame, feature: str, when_late: str, floor: float = 1e-6) -> DataFrame:
    """Population stability of a binned feature between an early and a late window.

    `when_late` is a boolean column; an empty bin counts as `floor` of its window.
    """
    binned = frame.groupBy(F.col(feature).alias("bin")).agg(
        F.count_if(~F.col(when_late)).alias("early"), F.count_if(F.col(when_late)).alias("late")
    )
    sizes = frame.agg(
        F.struct(
            F.count_if(~F.col(when_late)).alias("early"), F.count_if(F.col(when_late)).alias("late")
        )
    ).scalar()
    sized = binned.withColumn("_s", sizes)
    early = F.greatest(F.col("early") / F.col("_s.early"), F.lit(floor))
    late = F.greatest(F.col("late") / F.col("_s.late"), F.lit(floor))
    return sized.select(
        F.lit(feature).alias("feature"), F.col("bin").cast("string").alias("bin"),
        "early", "late",
        F.round((late - early) * F.log(late / early), 9).alias("psi"),
    )


def mean_shift(frame: DataFrame, features: list[str], when_late: str) -> DataFrame:
    """Mean of each feature in the early and the late window, and the shift in
    early standard deviations."""
    late = F.col(when_late)

    def shift(c: str):
        value = F.col(c).cast("double")
        early_value, late_value = F.when(~late, value), F.when(late, value)
        move = F.avg(late_value) - F.avg(early_value)
        return F.struct(
            F.lit(c).alias("feature"),
            F.round(F.avg(early_value), 6).alias("mean_early"),
            F.round(F.avg(late_value), 6).alias("mean_late"),
            F.round(move / F.nullif(F.stddev_samp(early_value), F.lit(0.0)), 6).alias("shift"),
        )

    return frame.agg(F.array(*[shift(c) for c in features]).alias("s")).select(F.inline("s"))


def with_effects(assigned: DataFrame, mart: DataFrame) -> DataFrame:
    """Bring the outcome columns back to assigned tickets, by ticket id."""
    effects = mart.select("incident_id", *S.EFFECT_COLUMNS)
    return assigned.join(effects, "incident_id", "left")
