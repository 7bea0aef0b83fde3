"""Column names, types and business constants shared by every job."""

from pyspark.sql import types as T

# --- Fixed values: raw export headers and the Bronze names they map to -------
RAW_HEADERS = {
    "Número": "Numero",
    "Prioridade": "Prioridade",
    "Produto": "Produto",
    "Categoria": "Categoria",
    "Subcategoria": "Subcategoria",
    "Grupo designado": "Grupo_designado",
    "Item de configuração": "Item_de_configuracao",
    "Aberto": "Aberto",
    "Resolvido": "Resolvido",
    "Encerrado": "Encerrado",
    "Duração": "Duracao",
    "Código de fechamento": "Codigo_de_fechamento",
    "Descrição resumida": "Descricao_resumida",
    "Solução": "Solucao",
    "Aberto por": "Aberto_por",
    "Incidente Pai": "Incidente_Pai",
    "Status": "Status",
    "Entrou para KPI?": "Entrou_para_KPI",
    "KPI Violado?": "KPI_Violado",
}

BRONZE = T.StructType(
    [
        T.StructField("Numero", T.StringType(), False),
        T.StructField("Prioridade", T.StringType(), False),
        T.StructField("Produto", T.StringType()),
        T.StructField("Categoria", T.StringType()),
        T.StructField("Subcategoria", T.StringType()),
        T.StructField("Grupo_designado", T.StringType()),
        T.StructField("Item_de_configuracao", T.StringType()),
        T.StructField("Aberto", T.TimestampNTZType(), False),
        T.StructField("Resolvido", T.TimestampNTZType()),
        T.StructField("Encerrado", T.TimestampNTZType()),
        T.StructField("Duracao", T.LongType()),
        T.StructField("Codigo_de_fechamento", T.StringType()),
        T.StructField("Descricao_resumida", T.StringType()),
        T.StructField("Solucao", T.StringType()),
        T.StructField("Aberto_por", T.StringType()),
        T.StructField("Incidente_Pai", T.StringType()),
        T.StructField("Status", T.StringType()),
        T.StructField("Entrou_para_KPI", T.StringType()),
        T.StructField("KPI_Violado", T.StringType()),
    ]
)
# The configuration item is optional in a raw export; all others are required.
REQUIRED = [f.name for f in BRONZE if f.name != "Item_de_configuracao"]

SILVER_ADDED = {
    "Exige_Intervencao": "int",
    "Prioridade_Num": "int",
    "Possui_Pai": "int",
    "Duracao_Horas": "double",
    "Data_Abertura": "date",
    "KPI_Status_Int": "int",
    "Target_Risco_SLA": "int",
    "Ano_Mes": "string",
}

# --- Fixed values: business rules --------------------------------------------
NOISE_STATUS = "Sem Intervenção"
FALLBACK_PRIORITY = 5
JOB_PRIORITY_TEXT = {"1 - Critica": 1, "2 - Alta": 2, "3 - Media": 3, "4 - Baixa": 4}

FILL_RULES = {
    "Produto": "Não Classificado",
    "Categoria": "Não Classificado",
    "Subcategoria": "Não Informada",
    "Incidente_Pai": "Independente",
    "Codigo_de_fechamento": "Não Encerrado",
    "Solucao": "Sem Descrição",
}
EXPLORE_FILL_RULES = {
    "Incidente_Pai": "Independente",
    "Codigo_de_fechamento": "Não Encerrado",
    "Solucao": "Sem Descrição de Solução",
    "Subcategoria": "Não Informada",
    "Item_de_configuracao": "Não Cadastrado",
}
SENTINEL_FILL_RULES = {
    "Aberto": "1900-01-01",
    "Resolvido": "1900-01-01",
    "Encerrado": "1900-01-01",
    "Duracao": 0,
    "Codigo_de_fechamento": "DESCONHECIDO",
    "Solucao": "NAO REGISTRADA",
    "Descricao_resumida": "SEM DESCRICAO",
}

NO_PARENT = "Independente"
TRIAGE_MISSING = "Não Informada"
NO_TECHNICIAN_CODES = ["Resolvido pelo Usuário", "Sem Descrição"]

# Hours a ticket is expected to take, and hours the contract allows.
EXPECTED_HOURS = {1: 4, 2: 8, 3: 24, 4: 72}
CONTRACT_HOURS = {1: 4, 2: 4, 3: 12, 4: 24, 5: 96}

# Annual goals per priority: accepted range of violations and of tickets.
ANNUAL_GOALS = [
    # priority, violations low, violations high, tickets low, tickets high
    (2, 36, 39, 5389, 6168),
    (3, 231, 263, 22117, 22524),
]

PRIORITY_BUCKETS = {
    1: "P1 - Critica",
    2: "P2 - Alta",
    3: "P3 - Moderada",
    4: "P4 - Baixa",
}
WEEKDAY_NAMES = ["Domingo", "Segunda", "Terca", "Quarta", "Quinta", "Sexta", "Sabado"]

# --- Fixed values: model inputs ----------------------------------------------
CAUSE_COLUMNS = [
    "prioridade_num", "grupo_designado", "categoria", "subcategoria", "produto",
    "hora_abertura", "turno_abertura", "dia_semana_num", "fora_horario_comercial",
    "abriu_fim_de_semana", "mes_abertura", "trimestre", "possui_pai",
    "triagem_incompleta",
]
EFFECT_COLUMNS = [
    "duracao_horas", "horas_ate_resolucao", "foi_resolvido",
    "excedeu_tempo_esperado", "fechado_sem_tecnico", "target_risco_sla",
    "score_risco_operacional",
]
CLUSTER_EXCLUDED = [
    "incident_id", "duracao_horas_scaled", "cluster_id", "is_filho_de_problema",
]
# Columns that tell the outcome; a risk model must never see them.
RISK_LEAKS = ["incident_id", "target_excedeu_tempo", "duracao_horas", "target_risco_sla"]
CYCLES = {"hora_abertura": 24, "dia_semana_num": 7, "mes_abertura": 12}
FREQUENCY_COLUMNS = ["grupo_designado", "subcategoria", "produto"]
ONE_HOT_COLUMNS = ["categoria", "turno_abertura"]
CLUSTER_LABELS = {0: "A", 1: "B", 2: "C", 3: "D"}
MODEL_KINDS = ["forecast_d1", "forecast_d7", "ola_risk", "clustering"]

MIN_DATE = "2025-01-01"
