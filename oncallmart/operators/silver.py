"""Bronze tickets to Silver tickets."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oncallmart import schema as S
from oncallmart.functions import calendar as C
from oncallmart.functions import tickets as X

PROFILES = ("canonical", "job")


def since(frame: DataFrame, min_date: str, column: str = "Aberto") -> DataFrame:
    """Tickets opened on or after a day; reaches the scan as a pushed filter."""
    return frame.where(F.to_date(column) >= F.lit(min_date).cast("date"))


def real_work(frame: DataFrame) -> DataFrame:
    """Without the tickets that nobody had to touch; an unknown status stays."""
    return frame.where(~F.col("Status").eqNullSafe(F.lit(S.NOISE_STATUS)))


def fill_nulls(frame: DataFrame, rules: dict[str, object] = S.FILL_RULES) -> DataFrame:
    return frame.withColumns(
        {
            c: F.coalesce(F.col(c), F.lit(v).cast(frame.schema[c].dataType))
            for c, v in rules.items()
            if c in frame.columns
        }
    )


def _canonical(frame: DataFrame) -> dict[str, Column]:
    kpi = X.kpi_status(F.col("KPI_Violado"))
    priority = X.priority_number(F.col("Prioridade"))
    hours = F.col("Duracao") / F.lit(3600.0)
    has_parent = X.flag(F.col("Incidente_Pai").isNotNull())
    work = X.needs_intervention(F.col("Status"))
    return {
        "Exige_Intervencao": work,
        "Prioridade_Num": priority,
        "Possui_Pai": has_parent,
        "Duracao_Horas": hours,
        "Data_Abertura": F.to_date("Aberto"),
        "KPI_Status_Int": kpi,
        "Target_Risco_SLA": X.risk_target(kpi, priority, hours, has_parent, work),
        "Ano_Mes": C.year_month(F.col("Aberto")),
    }


def _job(frame: DataFrame) -> dict[str, Column]:
    violated = X.said_yes(F.col("KPI_Violado").cast("string"))
    priority = X.priority_from_exact_text(F.col("Prioridade"))
    hours = F.coalesce(F.col("Duracao").cast("double") / F.lit(60.0), F.lit(0.0))
    return {
        "Exige_Intervencao": X.flag(X.said_yes(F.col("Entrou_para_KPI").cast("string"))),
        "Prioridade_Num": priority,
        "Possui_Pai": X.flag(F.col("Incidente_Pai").isNotNull()),
        "Duracao_Horas": hours,
        "Data_Abertura": F.to_date("Aberto"),
        "KPI_Status_Int": X.kpi_status(F.col("KPI_Violado").cast("string")),
        "Target_Risco_SLA": X.risk_target_any(violated, priority, hours),
        "Ano_Mes": C.year_month(F.col("Aberto")),
    }


def features(frame: DataFrame, profile: str = "canonical") -> DataFrame:
    """Add the derived Silver columns, from the unfilled values."""
    rules = {"canonical": _canonical, "job": _job}[profile](frame)
    return frame.withColumns(rules)


def silver(bronze: DataFrame, profile: str = "canonical") -> DataFrame:
    """Silver for every ticket; callers narrow it with `since` and `real_work`.

    The canonical profile derives features first and then fills six text columns.
    The job profile fills nulls with sentinels first, as the batch job does, and
    reads durations as minutes.
    """
    if profile == "canonical":
        return fill_nulls(features(bronze, profile))
    return features(fill_nulls(bronze, S.SENTINEL_FILL_RULES), profile)


def canonical_silver(bronze: DataFrame, min_date: str = S.MIN_DATE) -> DataFrame:
    """Real work since a day: the Silver table that is written out."""
    return silver(real_work(since(bronze, min_date)))
