"""Shared WITH clauses: test tables -> Bronze -> Silver -> feature table."""

# Constant texts, limits and names in these statements are fixed values of the data contract.
LINES = """
li AS (
  SELECT l_orderkey, min(l_partkey) AS pk, min(l_suppkey) AS sk FROM lineitem GROUP BY l_orderkey
)"""

BRONZE = LINES + """,
ord AS (
  SELECT o_orderkey AS k, o_custkey AS ck, o_orderstatus AS st,
         CAST(substr(o_orderpriority, 1, 1) AS INT) AS pn,
         o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS opened,
         (o_orderkey * 104729) % 600 AS r,
         o_orderkey % 8 = 3 AS kid
  FROM orders
),
ord2 AS (SELECT *, (r * r * r) // 600 AS secs FROM ord),
bronze AS (
  SELECT 'INC' || lpad(CAST(k AS VARCHAR), 9, '0') AS "Numero",
    CASE pn WHEN 1 THEN '1 - Crítica' WHEN 2 THEN '2 - Alta' WHEN 3 THEN '3 - Moderada'
            WHEN 4 THEN '4 - Baixa' WHEN 5 THEN '5 - Muito Baixa' END AS "Prioridade",
    p_brand AS "Produto", p_type AS "Categoria", p_name AS "Subcategoria",
    CASE WHEN k % 97 <> 0
         THEN 'Team' || lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') END AS "Grupo_designado",
    'CI-' || CAST(sk AS VARCHAR) AS "Item_de_configuracao",
    opened AS "Aberto",
    CASE WHEN st <> 'P' THEN opened + to_seconds((secs * 4) // 5) END AS "Resolvido",
    opened + to_seconds(secs) AS "Encerrado",
    CAST(secs AS BIGINT) AS "Duracao",
    CASE WHEN st = 'P' THEN NULL WHEN k % 5 = 0 THEN 'Resolvido pelo Usuário'
         WHEN k % 5 = 1 THEN 'Sem Descrição' ELSE 'Sucesso' END AS "Codigo_de_fechamento",
    coalesce(p_name, 'Sem item') AS "Descricao_resumida",
    CASE WHEN st <> 'P' THEN 'Solucao ' || CAST(k % 7 AS VARCHAR) END AS "Solucao",
    CASE WHEN st = 'P' THEN 'Monitoramento'
         ELSE 'User' || CAST(ck % 50 AS VARCHAR) END AS "Aberto_por",
    CASE WHEN kid THEN 'INC' || lpad(CAST(k - 3 AS VARCHAR), 9, '0') END AS "Incidente_Pai",
    CASE st WHEN 'F' THEN 'Encerrado' WHEN 'O' THEN 'Resolvido' ELSE 'Sem Intervenção' END
      AS "Status",
    CASE WHEN pn <= 3 AND NOT kid AND st <> 'P' THEN 'SIM' ELSE 'NAO' END AS "Entrou_para_KPI",
    CASE WHEN k % 10 = 7 THEN NULL
         WHEN pn <= 3 AND NOT kid AND st <> 'P' AND k % 4 = 0
              AND secs > 3600 * CASE pn WHEN 1 THEN 4 WHEN 2 THEN 4 ELSE 12 END
         THEN 'SIM' ELSE 'NAO' END AS "KPI_Violado"
  FROM ord2
  LEFT JOIN li ON k = l_orderkey
  LEFT JOIN customer ON ck = c_custkey
  LEFT JOIN part ON pk = p_partkey
)"""

SILVER_ADDED = """
    CASE WHEN "Status" IS DISTINCT FROM 'Sem Intervenção' THEN 1 ELSE 0 END AS "Exige_Intervencao",
    coalesce(TRY_CAST(regexp_extract("Prioridade", '([0-9])', 1) AS INT), 5) AS "Prioridade_Num",
    CASE WHEN "Incidente_Pai" IS NOT NULL THEN 1 ELSE 0 END AS "Possui_Pai",
    "Duracao" / 3600.0::DOUBLE AS "Duracao_Horas",
    CAST("Aberto" AS DATE) AS "Data_Abertura",
    CASE "KPI_Violado" WHEN 'SIM' THEN 1 WHEN 'NAO' THEN 0 ELSE -1 END AS "KPI_Status_Int","""

SILVER = BRONZE + """,
derived AS (
  SELECT *,""" + SILVER_ADDED + """
    strftime("Aberto", '%Y-%m') AS "Ano_Mes"
  FROM bronze
),
silver AS (
  SELECT * REPLACE (
      coalesce("Produto", 'Não Classificado') AS "Produto",
      coalesce("Categoria", 'Não Classificado') AS "Categoria",
      coalesce("Subcategoria", 'Não Informada') AS "Subcategoria",
      coalesce("Incidente_Pai", 'Independente') AS "Incidente_Pai",
      coalesce("Codigo_de_fechamento", 'Não Encerrado') AS "Codigo_de_fechamento",
      coalesce("Solucao", 'Sem Descrição') AS "Solucao"),
    CASE WHEN "Possui_Pai" = 1 OR "Exige_Intervencao" = 0 THEN 0
         WHEN "KPI_Status_Int" = 1 THEN 1
         WHEN "KPI_Status_Int" = -1 AND "Prioridade_Num" = 2 AND "Duracao_Horas" > 4 THEN 1
         ELSE 0 END AS "Target_Risco_SLA"
  FROM derived
)"""

EXCEEDS = """CASE WHEN {p} = 1 AND {h} > 4 THEN 1 WHEN {p} = 2 AND {h} > 8 THEN 1
         WHEN {p} = 3 AND {h} > 24 THEN 1 WHEN {p} = 4 AND {h} > 72 THEN 1 ELSE 0 END"""

SHIFT = """CASE WHEN hour({t}) >= 18 THEN 'Noite' WHEN hour({t}) >= 12 THEN 'Tarde'
         WHEN hour({t}) >= 6 THEN 'Manha' ELSE 'Madrugada' END"""
OFF_HOURS = "CASE WHEN hour({t}) < 8 OR hour({t}) > 18 THEN 1 ELSE 0 END"
WEEKEND = "CASE WHEN dayofweek({t}) IN (0, 6) THEN 1 ELSE 0 END"
SCORE = """(CASE WHEN {target} = 1 THEN 3 ELSE 0 END + CASE WHEN {p} <= 2 THEN 2 ELSE 0 END
      + CASE WHEN {work} = 1 THEN 1 ELSE 0 END + CASE WHEN {kid} = 1 THEN 1 ELSE 0 END
      + CASE WHEN hour({t}) BETWEEN 8 AND 18 THEN 0 ELSE 1 END)"""

BASE = SILVER + f""",
base AS (
  SELECT "Numero" AS incident_id, "Incidente_Pai" AS incidente_pai, "Aberto_por" AS aberto_por,
    "Prioridade" AS prioridade, "Prioridade_Num" AS prioridade_num, "Produto" AS produto,
    "Categoria" AS categoria, "Subcategoria" AS subcategoria,
    "Grupo_designado" AS grupo_designado, "Item_de_configuracao" AS item_configuracao,
    "Status" AS status, "Codigo_de_fechamento" AS codigo_fechamento,
    "Entrou_para_KPI" AS entrou_kpi, "KPI_Violado" AS kpi_violado,
    "KPI_Status_Int" AS kpi_status_int, "Possui_Pai" AS possui_pai,
    "Exige_Intervencao" AS exige_intervencao, "Target_Risco_SLA" AS target_risco_sla,
    "Duracao_Horas" AS duracao_horas, "Duracao" AS duracao_segundos, "Aberto" AS aberto_at,
    "Resolvido" AS resolvido_at, "Encerrado" AS encerrado_at, "Data_Abertura" AS data_abertura,
    CAST(hour("Aberto") AS INT) AS hora_abertura,
    CAST(dayofweek("Aberto") AS INT) AS dia_semana_num,
    CAST(weekofyear("Aberto") AS INT) AS semana_ano,
    CAST(month("Aberto") AS INT) AS mes_abertura,
    CAST(quarter("Aberto") AS INT) AS trimestre,
    "Ano_Mes" AS ano_mes,
    {SHIFT.format(t='"Aberto"')} AS turno_abertura,
    {OFF_HOURS.format(t='"Aberto"')} AS fora_horario_comercial,
    {WEEKEND.format(t='"Aberto"')} AS abriu_fim_de_semana,
    (epoch_us("Resolvido") - epoch_us("Aberto")) / 3.6e9::DOUBLE AS horas_ate_resolucao,
    CASE WHEN "Resolvido" IS NULL THEN 0 ELSE 1 END AS foi_resolvido,
    "Possui_Pai" AS is_filho_de_problema,
    CASE WHEN "Subcategoria" = 'Não Informada' THEN 1 ELSE 0 END AS triagem_incompleta,
    CASE WHEN "Codigo_de_fechamento" IN ('Resolvido pelo Usuário', 'Sem Descrição')
         THEN 1 ELSE 0 END AS fechado_sem_tecnico,
    {EXCEEDS.format(p='"Prioridade_Num"', h='"Duracao_Horas"')} AS excedeu_tempo_esperado,
    {SCORE.format(target='"Target_Risco_SLA"', p='"Prioridade_Num"', work='"Exige_Intervencao"',
                  kid='"Possui_Pai"', t='"Aberto"')} AS score_risco_operacional
  FROM silver WHERE "Exige_Intervencao" = 1
)"""

# Half-up rounding of a ratio of whole numbers to two places, without decimals.
ROUND2 = "((200 * ({a}) + ({b})) // (2 * ({b}))) / 100.0::DOUBLE"

DAILY = BASE + f""",
daily AS (
  SELECT data_abertura, dia_semana_num, semana_ano, mes_abertura, trimestre, ano_mes,
    max(abriu_fim_de_semana) AS is_fim_de_semana,
    count(*) AS total_chamados,
    count(*) FILTER (prioridade_num = 1) AS total_p1,
    count(*) FILTER (prioridade_num = 2) AS total_p2,
    count(*) FILTER (prioridade_num = 3) AS total_p3,
    count(*) FILTER (prioridade_num = 4) AS total_p4,
    count(*) FILTER (prioridade_num <= 2) AS total_criticos,
    CAST(sum(target_risco_sla) AS BIGINT) AS total_violacoes_sla,
    {ROUND2.format(a='100 * CAST(sum(target_risco_sla) AS BIGINT)', b='count(*)')}
      AS pct_violacao_sla,
    CAST(sum(score_risco_operacional) AS BIGINT) AS pressao_operacional_dia,
    CAST(sum(score_risco_operacional) AS BIGINT) / count(*)::DOUBLE AS score_risco_medio_dia,
    {ROUND2.format(a='CAST(sum(epoch_us(resolvido_at) - epoch_us(aberto_at)) AS BIGINT)',
                   b='count(resolvido_at) * 3600000000')} AS media_horas_resolucao
  FROM base GROUP BY ALL
)"""


def query(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"
