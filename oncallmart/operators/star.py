"""Star schema: six dimensions, the fact, and the joins between them."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oncallmart import schema as S
from oncallmart.functions import calendar as C
from oncallmart.functions import tickets as X

STATUS_MISSING = ("sem_status", "sem_codigo")
UNKNOWN = "Não Informado"


def opening_dimension(silver: DataFrame) -> DataFrame:
    at = F.col("Aberto")
    # Distinct over the one source column; the rest follows from it.
    return (
        silver.where(at.isNotNull()).select("Aberto").distinct().select(
            X.surrogate_key(at).alias("dim_abertura_sk"),
            at.alias("aberto_at"),
            F.hour(at).alias("hora_abertura"),
            C.shift(F.hour(at)).alias("turno_abertura"),
            C.off_hours(F.hour(at)).alias("fora_horario_comercial"),
            C.weekend(at).alias("abriu_fim_de_semana"),
        )
    )


def group_dimension(silver: DataFrame) -> DataFrame:
    group = F.col("Grupo_designado")
    return silver.where(group.isNotNull()).select("Grupo_designado").distinct().select(
        X.surrogate_key(group).alias("dim_grupo_sk"), group.alias("grupo_designado")
    )


def priority_dimension(silver: DataFrame) -> DataFrame:
    """One row per (number, text); two spellings of one number give two rows."""
    number = F.col("Prioridade_Num")
    return (
        silver.where(number.isNotNull()).select("Prioridade_Num", "Prioridade").distinct().select(
            X.surrogate_key(number).alias("dim_prioridade_sk"),
            number.alias("prioridade_num"),
            F.col("Prioridade").alias("prioridade_texto"),
            X.priority_bucket(number).alias("bucket_prioridade"),
            F.when(number <= 2, "Critico").otherwise("Normal").alias("nivel_criticidade"),
            X.limit_hours(S.EXPECTED_HOURS, number).alias("threshold_sla_horas"),
        )
    )


def product_dimension(silver: DataFrame) -> DataFrame:
    names = ["Produto", "Categoria", "Subcategoria"]
    return silver.select(*names).distinct().select(
        X.surrogate_key(*[F.col(n) for n in names]).alias("dim_produto_categoria_sk"),
        *[F.col(n).alias(n.lower()) for n in names],
    )


def _status_key():
    return X.surrogate_key(
        F.col("Status"), F.col("Codigo_de_fechamento"), missing=STATUS_MISSING
    )


def status_dimension(silver: DataFrame) -> DataFrame:
    """Distinct over the KPI flag too, so a key can appear more than once."""
    return (
        silver.where(F.col("Status").isNotNull())
        .select("Status", "Codigo_de_fechamento", "Entrou_para_KPI")
        .distinct()
        .select(
            _status_key().alias("dim_status_sk"),
            F.coalesce("Status", F.lit(UNKNOWN)).alias("status"),
            F.coalesce("Codigo_de_fechamento", F.lit(UNKNOWN)).alias("codigo_fechamento"),
            F.col("Entrou_para_KPI").alias("entrou_kpi"),
        )
    )


def status_by_key(dimension: DataFrame) -> DataFrame:
    """One row per key, for joins; the flag is SIM when any of the rows had it.

    The flag is compared as a number, which keeps this a hash aggregate.
    """
    eligible = F.max((F.col("entrou_kpi") == "SIM").cast("int"))
    return dimension.groupBy("dim_status_sk", "status", "codigo_fechamento").agg(
        F.when(eligible == 1, "SIM").when(eligible == 0, "NAO").alias("entrou_kpi")
    )


def priority_by_key(dimension: DataFrame) -> DataFrame:
    """One row per number, with the first of its spellings; the rest follows from it."""
    by_number = [c for c in dimension.columns if c != "prioridade_texto"]
    return dimension.groupBy(*by_number).agg(
        F.array_min(F.collect_set("prioridade_texto")).alias("prioridade_texto")
    )


def day_dimension(silver: DataFrame) -> DataFrame:
    day = F.col("Data_Abertura")
    return silver.where(day.isNotNull()).select("Data_Abertura").distinct().select(
        X.surrogate_key(day).alias("dim_tempo_sk"),
        day.alias("data_abertura"),
        F.year(day).alias("ano"),
        F.month(day).alias("mes_num"),
        C.month_name_padded(day).alias("nome_mes"),
        F.weekofyear(day).alias("semana_ano"),
        F.quarter(day).alias("trimestre"),
        C.year_month(day).alias("ano_mes"),
        C.day_of_week(day).alias("dia_semana_num"),
        C.weekday_name(day).alias("nome_dia"),
        C.weekend(day).alias("is_fim_de_semana"),
    )


KEY_SOURCES = [
    "Numero", "Produto", "Categoria", "Subcategoria", "Grupo_designado", "Data_Abertura",
    "Status", "Codigo_de_fechamento", "Entrou_para_KPI", "Prioridade", "Prioridade_Num", "Aberto",
]


# What the whole fact needs besides.
FACT_SOURCES = [
    *KEY_SOURCES, "Duracao_Horas", "Duracao", "KPI_Status_Int", "Target_Risco_SLA",
    "Exige_Intervencao", "Possui_Pai", "Resolvido", "Incidente_Pai", "Encerrado",
]


def _keys() -> list[Column]:
    def key(name: str, *sources: str) -> Column:
        return X.surrogate_key(*[F.col(s) for s in sources]).alias(name)

    return [
        key("incident_sk", "Numero"),
        key("dim_produto_categoria_sk", "Produto", "Categoria", "Subcategoria"),
        key("dim_grupo_sk", "Grupo_designado"),
        key("dim_tempo_sk", "Data_Abertura"),
        _status_key().alias("dim_status_sk"),
        key("dim_prioridade_sk", "Prioridade_Num"),
        key("dim_abertura_sk", "Aberto"),
    ]


def fact_keys(silver: DataFrame) -> DataFrame:
    """Only the keys of the fact; needs no more than `KEY_SOURCES`."""
    return silver.select(*_keys())


def fact(silver: DataFrame) -> DataFrame:
    """One row per ticket: keys, measures and flags, in a single projection."""
    c = F.col
    return silver.select(
        *_keys(),
        c("Numero").alias("incident_id"),
        c("Duracao_Horas").alias("duracao_horas"),
        c("Duracao").alias("duracao_segundos"),
        c("KPI_Status_Int").alias("kpi_status_int"),
        c("Target_Risco_SLA").alias("target_risco_sla"),
        c("Exige_Intervencao").cast("int").alias("exige_intervencao"),
        c("Possui_Pai").alias("possui_pai"),
        X.hours_between(c("Aberto"), c("Resolvido")).alias("horas_ate_resolucao"),
        X.flag(c("Resolvido").isNotNull()).alias("foi_resolvido"),
        X.flag(c("Incidente_Pai") != S.NO_PARENT).alias("is_filho_de_problema"),
        X.flag(c("Subcategoria") == S.TRIAGE_MISSING).alias("triagem_incompleta"),
        X.flag(c("Codigo_de_fechamento").isin(S.NO_TECHNICIAN_CODES)).alias(
            "fechado_sem_tecnico"
        ),
        X.exceeds(S.EXPECTED_HOURS, c("Prioridade_Num"), c("Duracao_Horas")).alias(
            "excedeu_tempo_esperado"
        ),
        X.operational_risk_score(
            c("Target_Risco_SLA"), c("Prioridade_Num"), c("Exige_Intervencao"),
            c("Possui_Pai"), C.off_hours(F.hour(c("Aberto"))),
        ).alias("score_risco_operacional"),
        c("Aberto").alias("aberto_at"),
        c("Resolvido").alias("resolvido_at"),
        c("Encerrado").alias("encerrado_at"),
    )


def dimensions(silver: DataFrame) -> dict[str, DataFrame]:
    """The dimensions as published."""
    return {
        "dim_abertura": opening_dimension(silver),
        "dim_grupo": group_dimension(silver),
        "dim_prioridade": priority_dimension(silver),
        "dim_produto_categoria": product_dimension(silver),
        "dim_status": status_dimension(silver),
        "dim_tempo": day_dimension(silver),
    }


def joinable(dims: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The same dimensions with one row per key, so a join never fans out."""
    return {
        **dims,
        "dim_status": status_by_key(dims["dim_status"]),
        "dim_prioridade": priority_by_key(dims["dim_prioridade"]),
    }


def star_join(facts: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fact with the attributes of all six dimensions.

    No broadcast hints: the size of a dimension follows the data, so the planner
    compares its measured size with the broadcast threshold at run time and
    otherwise sorts and merges, splitting partitions of a hot key.
    """
    taken = set(facts.columns)
    parts = joinable(dims)
    renamed = {}
    for name in [*(n for n in parts if n != "dim_abertura"), "dim_abertura"]:
        dim, key = parts[name], f"{name}_sk"
        renamed[name] = dim.select(
            key,
            *[
                F.col(c).alias(c if c not in taken else f"{name}_{c}")
                for c in dim.columns
                if c != key
            ],
        )
        taken |= set(renamed[name].columns)
    # Columns in the order in which each join by name puts its key first.
    names = list(facts.columns)
    for name, dim in renamed.items():
        key = f"{name}_sk"
        names = [key, *(c for c in names if c != key), *(c for c in dim.columns if c != key)]
    # The dimension of opening times has about as many rows as the fact and comes first: its
    # join moves both, the rows without the attributes of the others, which are small.
    out = facts
    for name in ["dim_abertura", *(n for n in renamed if n != "dim_abertura")]:
        out = out.join(renamed[name], f"{name}_sk", "left")
    return out.select(*names)
