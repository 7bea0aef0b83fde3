"""Feature table and the three model marts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oncallmart import schema as S
from oncallmart.functions import calendar as C
from oncallmart.functions import numeric as N
from oncallmart.functions import tickets as X

PASSED_THROUGH = {
    "Numero": "incident_id",
    "Incidente_Pai": "incidente_pai",
    "Aberto_por": "aberto_por",
    "Prioridade": "prioridade",
    "Prioridade_Num": "prioridade_num",
    "Produto": "produto",
    "Categoria": "categoria",
    "Subcategoria": "subcategoria",
    "Grupo_designado": "grupo_designado",
    "Item_de_configuracao": "item_configuracao",
    "Status": "status",
    "Codigo_de_fechamento": "codigo_fechamento",
    "Entrou_para_KPI": "entrou_kpi",
    "KPI_Violado": "kpi_violado",
    "KPI_Status_Int": "kpi_status_int",
    "Possui_Pai": "possui_pai",
    "Exige_Intervencao": "exige_intervencao",
    "Target_Risco_SLA": "target_risco_sla",
    "Duracao_Horas": "duracao_horas",
    "Duracao": "duracao_segundos",
    "Aberto": "aberto_at",
    "Resolvido": "resolvido_at",
    "Encerrado": "encerrado_at",
    "Data_Abertura": "data_abertura",
}


def base_features(silver: DataFrame) -> DataFrame:
    """One row per ticket that needed work, with every feature the marts use."""
    named = silver.where(F.col("Exige_Intervencao") == 1).select(
        [F.col(c).alias(n) for c, n in PASSED_THROUGH.items()]
    )
    at = F.col("aberto_at")
    dated = named.withColumns(
        {"hora_abertura": F.hour(at), "dia_semana_num": C.day_of_week(at)}
    )
    hour = F.col("hora_abertura")
    off = C.off_hours(hour)
    return dated.withColumns(
        {
            "semana_ano": F.weekofyear(at),
            "mes_abertura": F.month(at),
            "trimestre": F.quarter(at),
            "ano_mes": C.year_month(at),
            "turno_abertura": C.shift(hour),
            "fora_horario_comercial": off,
            "abriu_fim_de_semana": C.is_weekend(F.col("dia_semana_num")),
            "horas_ate_resolucao": X.hours_between(at, F.col("resolvido_at")),
            "foi_resolvido": X.flag(F.col("resolvido_at").isNotNull()),
            "is_filho_de_problema": X.flag(F.col("possui_pai") == 1),
            "triagem_incompleta": X.flag(F.col("subcategoria") == S.TRIAGE_MISSING),
            "fechado_sem_tecnico": X.flag(F.col("codigo_fechamento").isin(S.NO_TECHNICIAN_CODES)),
            "excedeu_tempo_esperado": X.exceeds(
                S.EXPECTED_HOURS, F.col("prioridade_num"), F.col("duracao_horas")
            ),
            "score_risco_operacional": X.operational_risk_score(
                F.col("target_risco_sla"), F.col("prioridade_num"),
                F.col("exige_intervencao"), F.col("possui_pai"), off,
            ),
        }
    )


DAY_COLUMNS = [
    "data_abertura", "dia_semana_num", "semana_ano", "mes_abertura", "trimestre", "ano_mes",
]


def forecast_mart(base: DataFrame) -> DataFrame:
    """One row per day: volume, breakdowns, violations and pressure.

    Means come from whole microseconds and counts, so the result does not depend
    on the order in which partial aggregates are merged. Unordered: sort at the
    sink if a reader needs it.
    """
    def count_where(condition):
        return F.count_if(condition)

    micros = F.timestamp_diff("MICROSECOND", F.col("aberto_at"), F.col("resolvido_at"))
    daily = base.groupBy(*DAY_COLUMNS).agg(
        F.max("abriu_fim_de_semana").alias("is_fim_de_semana"),
        F.count("*").alias("total_chamados"),
        *[
            count_where(F.col("prioridade_num") == p).alias(f"total_p{p}")
            for p in (1, 2, 3, 4)
        ],
        count_where(F.col("prioridade_num") <= 2).alias("total_criticos"),
        F.sum("target_risco_sla").alias("total_violacoes_sla"),
        F.sum("score_risco_operacional").alias("pressao_operacional_dia"),
        F.sum(micros).alias("micros"),
        F.count(micros).alias("resolved"),
    )
    total = F.col("total_chamados")
    mean_hours = F.col("micros").cast("decimal(24,0)") / (
        F.lit(3_600_000_000).cast("decimal(10,0)") * F.nullif(F.col("resolved"), F.lit(0))
    )
    return daily.select(
        *DAY_COLUMNS,
        "is_fim_de_semana", "total_chamados", "total_p1", "total_p2", "total_p3", "total_p4",
        "total_criticos", "total_violacoes_sla",
        N.percent_2(F.col("total_violacoes_sla"), total).alias("pct_violacao_sla"),
        "pressao_operacional_dia",
        (F.col("pressao_operacional_dia") / total).alias("score_risco_medio_dia"),
        F.round(mean_hours, 2).cast("double").alias("media_horas_resolucao"),
    )


def sla_mart(base: DataFrame) -> DataFrame:
    """What is known when a ticket opens, and the two targets."""
    return base.select(
        "incident_id", "prioridade_num", "grupo_designado", "categoria", "subcategoria",
        "possui_pai", "is_filho_de_problema", "triagem_incompleta", "hora_abertura",
        "dia_semana_num", "turno_abertura", "fora_horario_comercial", "abriu_fim_de_semana",
        "semana_ano", "mes_abertura", "duracao_horas", "target_risco_sla",
        F.col("excedeu_tempo_esperado").alias("target_excedeu_tempo"),
    )


def cluster_mart(base: DataFrame) -> DataFrame:
    """Cause and effect of every ticket, with room for the model's output."""
    return base.select(
        "incident_id", "prioridade_num", "grupo_designado", "categoria", "subcategoria",
        "produto", "hora_abertura", "turno_abertura", "dia_semana_num",
        "fora_horario_comercial", "abriu_fim_de_semana", "mes_abertura", "trimestre",
        "possui_pai", "is_filho_de_problema", "triagem_incompleta",
        "duracao_horas", "horas_ate_resolucao", "foi_resolvido", "excedeu_tempo_esperado",
        "fechado_sem_tecnico", "target_risco_sla", "kpi_status_int", "score_risco_operacional",
        F.lit(None).cast("double").alias("duracao_horas_scaled"),
        F.lit(None).cast("int").alias("cluster_id"),
    )
