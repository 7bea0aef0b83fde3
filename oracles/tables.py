"""Bronze, Silver, star schema and marts."""

# Constant texts, limits and column names here are fixed values of the data contract.

from oracles.common import (
    BASE, BRONZE, DAILY, EXCEEDS, OFF_HOURS, SCORE, SHIFT, SILVER, WEEKEND, query,
)

STATUS_KEY = """md5(coalesce("Status", 'sem_status') || '||' ||
      coalesce("Codigo_de_fechamento", 'sem_codigo'))"""
PRODUCT_KEY = """md5(coalesce("Produto", '') || '||' || coalesce("Categoria", '') || '||' ||
      coalesce("Subcategoria", ''))"""

DIMS = SILVER + f""",
dim_abertura AS (
  SELECT DISTINCT md5(CAST("Aberto" AS VARCHAR)) AS dim_abertura_sk, "Aberto" AS aberto_at,
    CAST(hour("Aberto") AS INT) AS hora_abertura,
    {SHIFT.format(t='"Aberto"')} AS turno_abertura,
    {OFF_HOURS.format(t='"Aberto"')} AS fora_horario_comercial,
    {WEEKEND.format(t='"Aberto"')} AS abriu_fim_de_semana
  FROM silver WHERE "Aberto" IS NOT NULL
),
dim_grupo AS (
  SELECT DISTINCT md5("Grupo_designado") AS dim_grupo_sk, "Grupo_designado" AS grupo_designado
  FROM silver WHERE "Grupo_designado" IS NOT NULL
),
dim_prioridade AS (
  SELECT DISTINCT md5(CAST("Prioridade_Num" AS VARCHAR)) AS dim_prioridade_sk,
    "Prioridade_Num" AS prioridade_num, "Prioridade" AS prioridade_texto,
    CASE "Prioridade_Num" WHEN 1 THEN 'P1 - Critica' WHEN 2 THEN 'P2 - Alta'
      WHEN 3 THEN 'P3 - Moderada' WHEN 4 THEN 'P4 - Baixa' ELSE 'Nao Classificada' END
      AS bucket_prioridade,
    CASE WHEN "Prioridade_Num" <= 2 THEN 'Critico' ELSE 'Normal' END AS nivel_criticidade,
    CASE "Prioridade_Num" WHEN 1 THEN 4 WHEN 2 THEN 8 WHEN 3 THEN 24 WHEN 4 THEN 72 END
      AS threshold_sla_horas
  FROM silver WHERE "Prioridade_Num" IS NOT NULL
),
dim_produto_categoria AS (
  SELECT DISTINCT {PRODUCT_KEY} AS dim_produto_categoria_sk, "Produto" AS produto,
    "Categoria" AS categoria, "Subcategoria" AS subcategoria
  FROM silver
),
dim_status AS (
  SELECT DISTINCT {STATUS_KEY} AS dim_status_sk,
    coalesce("Status", 'Não Informado') AS status,
    coalesce("Codigo_de_fechamento", 'Não Informado') AS codigo_fechamento,
    "Entrou_para_KPI" AS entrou_kpi
  FROM silver WHERE "Status" IS NOT NULL
),
dim_tempo AS (
  SELECT DISTINCT md5(CAST("Data_Abertura" AS VARCHAR)) AS dim_tempo_sk,
    "Data_Abertura" AS data_abertura,
    CAST(year("Data_Abertura") AS INT) AS ano, CAST(month("Data_Abertura") AS INT) AS mes_num,
    rpad(monthname("Data_Abertura"), 9, ' ') AS nome_mes,
    CAST(weekofyear("Data_Abertura") AS INT) AS semana_ano,
    CAST(quarter("Data_Abertura") AS INT) AS trimestre, "Ano_Mes" AS ano_mes,
    CAST(dayofweek("Data_Abertura") AS INT) AS dia_semana_num,
    CASE dayofweek("Data_Abertura") WHEN 0 THEN 'Domingo' WHEN 1 THEN 'Segunda'
      WHEN 2 THEN 'Terca' WHEN 3 THEN 'Quarta' WHEN 4 THEN 'Quinta' WHEN 5 THEN 'Sexta'
      ELSE 'Sabado' END AS nome_dia,
    {WEEKEND.format(t='"Data_Abertura"')} AS is_fim_de_semana
  FROM silver WHERE "Data_Abertura" IS NOT NULL
),
fct AS (
  SELECT md5("Numero") AS incident_sk, {PRODUCT_KEY} AS dim_produto_categoria_sk,
    md5(coalesce("Grupo_designado", '')) AS dim_grupo_sk,
    md5(CAST("Data_Abertura" AS VARCHAR)) AS dim_tempo_sk, {STATUS_KEY} AS dim_status_sk,
    md5(CAST("Prioridade_Num" AS VARCHAR)) AS dim_prioridade_sk,
    md5(CAST("Aberto" AS VARCHAR)) AS dim_abertura_sk,
    "Numero" AS incident_id, "Duracao_Horas" AS duracao_horas, "Duracao" AS duracao_segundos,
    "KPI_Status_Int" AS kpi_status_int, "Target_Risco_SLA" AS target_risco_sla,
    "Exige_Intervencao" AS exige_intervencao, "Possui_Pai" AS possui_pai,
    (epoch_us("Resolvido") - epoch_us("Aberto")) / 3.6e9::DOUBLE AS horas_ate_resolucao,
    CASE WHEN "Resolvido" IS NULL THEN 0 ELSE 1 END AS foi_resolvido,
    CASE WHEN "Incidente_Pai" <> 'Independente' THEN 1 ELSE 0 END AS is_filho_de_problema,
    CASE WHEN "Subcategoria" = 'Não Informada' THEN 1 ELSE 0 END AS triagem_incompleta,
    CASE WHEN "Codigo_de_fechamento" IN ('Resolvido pelo Usuário', 'Sem Descrição')
         THEN 1 ELSE 0 END AS fechado_sem_tecnico,
    {EXCEEDS.format(p='"Prioridade_Num"', h='"Duracao_Horas"')} AS excedeu_tempo_esperado,
    {SCORE.format(target='"Target_Risco_SLA"', p='"Prioridade_Num"', work='"Exige_Intervencao"',
                  kid='"Possui_Pai"', t='"Aberto"')} AS score_risco_operacional,
    "Aberto" AS aberto_at, "Resolvido" AS resolvido_at, "Encerrado" AS encerrado_at
  FROM silver
)"""

JOB = BRONZE + """,
filled AS (
  SELECT * REPLACE (
      coalesce("Aberto", TIMESTAMP '1900-01-01') AS "Aberto",
      coalesce("Resolvido", TIMESTAMP '1900-01-01') AS "Resolvido",
      coalesce("Encerrado", TIMESTAMP '1900-01-01') AS "Encerrado",
      coalesce("Duracao", 0) AS "Duracao",
      coalesce("Codigo_de_fechamento", 'DESCONHECIDO') AS "Codigo_de_fechamento",
      coalesce("Solucao", 'NAO REGISTRADA') AS "Solucao",
      coalesce("Descricao_resumida", 'SEM DESCRICAO') AS "Descricao_resumida")
  FROM bronze
),
job AS (
  SELECT *,
    CASE WHEN "Entrou_para_KPI" = 'SIM' THEN 1 ELSE 0 END AS "Exige_Intervencao",
    CASE "Prioridade" WHEN '1 - Critica' THEN 1 WHEN '2 - Alta' THEN 2 WHEN '3 - Media' THEN 3
      WHEN '4 - Baixa' THEN 4 ELSE 5 END AS "Prioridade_Num",
    CASE WHEN "Incidente_Pai" IS NOT NULL THEN 1 ELSE 0 END AS "Possui_Pai",
    "Duracao" / 60.0::DOUBLE AS "Duracao_Horas",
    CAST("Aberto" AS DATE) AS "Data_Abertura",
    CASE "KPI_Violado" WHEN 'SIM' THEN 1 WHEN 'NAO' THEN 0 ELSE -1 END AS "KPI_Status_Int",
    strftime("Aberto", '%Y-%m') AS "Ano_Mes"
  FROM filled
),
job2 AS (
  SELECT *, CASE WHEN coalesce("KPI_Violado" = 'SIM', false) OR "Prioridade_Num" <= 2
    OR "Duracao_Horas" > 8 THEN 1 ELSE 0 END AS "Target_Risco_SLA" FROM job
)"""

QUERIES = {
    "bronze_tickets": query(BRONZE, "SELECT * FROM bronze"),
    "headers_normalised": query(BRONZE, """SELECT * REPLACE (
        CASE WHEN CAST(substr("Numero", 4) AS BIGINT) % 13 = 0 THEN NULL ELSE "Duracao" END
          AS "Duracao",
        CASE WHEN CAST(substr("Numero", 4) AS BIGINT) % 17 = 0 THEN NULL ELSE "Resolvido" END
          AS "Resolvido") FROM bronze"""),
    "text_columns": query(BRONZE, """SELECT * REPLACE (CAST("Duracao" AS VARCHAR) AS "Duracao",
        CAST("Aberto" AS VARCHAR) AS "Aberto", CAST("Resolvido" AS VARCHAR) AS "Resolvido",
        CAST("Encerrado" AS VARCHAR) AS "Encerrado") FROM bronze"""),
    "lost_cells": query(BRONZE, """SELECT * FROM (VALUES
        ('Aberto', 0::BIGINT), ('Encerrado', 0::BIGINT)) v("column", lost)
        UNION ALL SELECT 'Resolvido', count(*) FROM bronze
          WHERE CAST(substr("Numero", 4) AS BIGINT) % 17 = 0
        UNION ALL SELECT 'Duracao', count(*) FROM bronze
          WHERE CAST(substr("Numero", 4) AS BIGINT) % 13 = 0"""),
    "silver_canonical": query(SILVER, """SELECT * FROM silver
        WHERE "Status" <> 'Sem Intervenção' AND "Aberto" >= TIMESTAMP '1999-01-01'"""),
    "silver_job_profile": query(JOB, """SELECT * FROM job2
        WHERE "Data_Abertura" >= DATE '1999-01-01'"""),
    "target_layered": query(SILVER, """SELECT "Target_Risco_SLA" AS target,
        "Prioridade_Num" AS prioridade_num, "KPI_Status_Int" AS kpi_status_int,
        count(*) AS tickets FROM silver GROUP BY ALL"""),
    "target_or": query(JOB, """SELECT "Target_Risco_SLA" AS target,
        "Prioridade_Num" AS prioridade_num, "KPI_Status_Int" AS kpi_status_int,
        count(*) AS tickets FROM job2 GROUP BY ALL"""),
    "null_fill": query(SILVER, """SELECT "Numero", "Produto", "Categoria", "Subcategoria",
        "Incidente_Pai", "Codigo_de_fechamento", "Solucao" FROM silver"""),
    "null_fill_explore": query(BRONZE, """SELECT "Numero",
        coalesce("Incidente_Pai", 'Independente') AS "Incidente_Pai",
        coalesce("Codigo_de_fechamento", 'Não Encerrado') AS "Codigo_de_fechamento",
        coalesce("Solucao", 'Sem Descrição de Solução') AS "Solucao",
        coalesce("Subcategoria", 'Não Informada') AS "Subcategoria",
        coalesce("Item_de_configuracao", 'Não Cadastrado') AS "Item_de_configuracao"
        FROM bronze"""),
    "kpi_text_clean": query(BRONZE, """SELECT "KPI_Violado" AS kpi_violado,
        CASE WHEN "KPI_Violado" = 'SIM' THEN 1 ELSE 0 END AS kpi_status_int,
        count(*) AS tickets FROM bronze GROUP BY ALL"""),
    "base_features": query(BASE, "SELECT * FROM base"),
    "mart_daily": query(DAILY, "SELECT * FROM daily"),
    "mart_sla": query(BASE, """SELECT incident_id, prioridade_num, grupo_designado, categoria,
        subcategoria, possui_pai, is_filho_de_problema, triagem_incompleta, hora_abertura,
        dia_semana_num, turno_abertura, fora_horario_comercial, abriu_fim_de_semana, semana_ano,
        mes_abertura, duracao_horas, target_risco_sla,
        excedeu_tempo_esperado AS target_excedeu_tempo FROM base"""),
    "mart_cluster": query(BASE, """SELECT incident_id, prioridade_num, grupo_designado, categoria,
        subcategoria, produto, hora_abertura, turno_abertura, dia_semana_num,
        fora_horario_comercial, abriu_fim_de_semana, mes_abertura, trimestre, possui_pai,
        is_filho_de_problema, triagem_incompleta, duracao_horas, horas_ate_resolucao,
        foi_resolvido, excedeu_tempo_esperado, fechado_sem_tecnico, target_risco_sla,
        kpi_status_int, score_risco_operacional, CAST(NULL AS DOUBLE) AS duracao_horas_scaled,
        CAST(NULL AS INT) AS cluster_id FROM base"""),
    **{
        name: query(DIMS, f"SELECT * FROM {name}")
        for name in (
            "dim_abertura", "dim_grupo", "dim_prioridade", "dim_produto_categoria",
            "dim_status", "dim_tempo",
        )
    },
    "fct_incidents": query(DIMS, "SELECT * FROM fct"),
    "star_join": query(DIMS, """SELECT f.*, a.turno_abertura, a.abriu_fim_de_semana,
        a.hora_abertura, a.fora_horario_comercial, a.aberto_at AS dim_abertura_aberto_at,
        g.grupo_designado, p.prioridade_num, p.prioridade_texto, p.bucket_prioridade,
        p.nivel_criticidade, p.threshold_sla_horas, c.produto, c.categoria, c.subcategoria,
        s.status, s.codigo_fechamento, s.entrou_kpi, t.data_abertura, t.ano, t.mes_num,
        t.nome_mes, t.semana_ano, t.trimestre, t.ano_mes, t.dia_semana_num, t.nome_dia,
        t.is_fim_de_semana
      FROM fct f
      LEFT JOIN dim_abertura a USING (dim_abertura_sk)
      LEFT JOIN dim_grupo g USING (dim_grupo_sk)
      LEFT JOIN dim_prioridade p USING (dim_prioridade_sk)
      LEFT JOIN dim_produto_categoria c USING (dim_produto_categoria_sk)
      LEFT JOIN (SELECT dim_status_sk, min(status) AS status,
                   min(codigo_fechamento) AS codigo_fechamento, max(entrou_kpi) AS entrou_kpi
                 FROM dim_status GROUP BY 1) s USING (dim_status_sk)
      LEFT JOIN dim_tempo t USING (dim_tempo_sk)"""),
    "status_join_unique": query(DIMS, """SELECT d.status, d.codigo_fechamento, d.entrou_kpi,
        count(*) AS tickets, count(DISTINCT f.incident_sk) AS incidents
      FROM fct f JOIN (SELECT dim_status_sk, min(status) AS status,
                   min(codigo_fechamento) AS codigo_fechamento, max(entrou_kpi) AS entrou_kpi
                 FROM dim_status GROUP BY 1) d USING (dim_status_sk) GROUP BY 1, 2, 3"""),
    # A window is open until the newest event is ten minutes past its end.
    "events_hourly": """SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS volume,
        date_trunc('hour', ts) + INTERVAL 1 HOUR > (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE AS open
      FROM events WHERE ts IS NOT NULL GROUP BY ALL""",
}
