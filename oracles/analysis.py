"""Analyses, calendars, quality, series, preparation and evaluation."""

from oracles.common import BASE, BRONZE, DAILY, OFF_HOURS, ROUND2, SHIFT, SILVER, WEEKEND, query
from oracles.tables import DIMS, JOB

QUERIES = {}


def add(name, ctes, select):
    QUERIES[name] = query(ctes, select)


# --- Calendars --------------------------------------------------------------------

add("date_parts", SILVER, f"""SELECT "Numero", CAST(hour("Aberto") AS INT) AS hora,
  CAST(dayofweek("Aberto") AS INT) AS dow, CAST(weekofyear("Aberto") AS INT) AS semana,
  CAST(month("Aberto") AS INT) AS mes, CAST(quarter("Aberto") AS INT) AS trimestre,
  "Ano_Mes" AS ano_mes, {SHIFT.format(t='"Aberto"')} AS turno,
  {OFF_HOURS.format(t='"Aberto"')} AS fora_horario, {WEEKEND.format(t='"Aberto"')} AS fim_de_semana,
  ['Domingo', 'Segunda', 'Terca', 'Quarta', 'Quinta', 'Sexta', 'Sabado'][dayofweek("Aberto") + 1]
    AS nome_dia,
  rpad(monthname("Aberto"), 9, ' ') AS nome_mes
FROM silver""")

HOLIDAYS = """,
yrs AS (
  SELECT unnest(range(min(year("Aberto")), max(year("Aberto")) + 1)) AS y FROM bronze
),
-- Easter by the Meeus/Jones/Butcher rule, one step per CTE.
e1 AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM yrs),
e2 AS (SELECT *, b // 4 AS d, b % 4 AS e, (b + 8) // 25 AS f, c // 4 AS i, c % 4 AS k FROM e1),
e3 AS (SELECT *, (b - f + 1) // 3 AS g FROM e2),
e4 AS (SELECT *, (19 * a + b - d - g + 15) % 30 AS h FROM e3),
e5 AS (SELECT *, (32 + 2 * e + 2 * i - h - k) % 7 AS l FROM e4),
e6 AS (SELECT *, (a + 11 * h + 22 * l) // 451 AS m FROM e5),
easter AS (
  SELECT y, make_date(y, (h + l - 7 * m + 114) // 31, (h + l - 7 * m + 114) % 31 + 1) AS sunday
  FROM e6
),
fixed(mo, d, since, name) AS (
  VALUES (1, 1, 0, 'Confraternização Universal'), (4, 21, 0, 'Tiradentes'),
    (5, 1, 0, 'Dia do Trabalhador'), (9, 7, 0, 'Independência do Brasil'),
    (10, 12, 1980, 'Nossa Senhora Aparecida'), (11, 2, 0, 'Finados'),
    (11, 15, 0, 'Proclamação da República'),
    (11, 20, 2024, 'Dia Nacional de Zumbi e da Consciência Negra'), (12, 25, 0, 'Natal')
),
holidays AS (
  SELECT make_date(y, mo, d) AS day, name FROM yrs, fixed WHERE y >= since
  UNION ALL SELECT sunday - 2, 'Sexta-feira Santa' FROM easter
)"""
add("holidays", BRONZE + HOLIDAYS, "SELECT CAST(day AS DATE) AS day, name FROM holidays")

KIND = """CASE WHEN "Data_Abertura" IN (SELECT CAST(day AS DATE) FROM holidays) THEN 'Feriado'
  WHEN dayofweek("Data_Abertura") IN (0, 6) THEN 'Final de Semana' ELSE 'Dia Útil' END"""
add("day_type", SILVER + HOLIDAYS, f"""SELECT "Numero", "Data_Abertura", {KIND} AS tipo_dia
FROM silver""")
add("day_type_impact", SILVER + HOLIDAYS, f"""SELECT tipo_dia, count(*) AS dias,
  CAST(sum(v) AS BIGINT) AS volume_total,
  ((20 * CAST(sum(v) AS BIGINT) + count(*)) // (2 * count(*))) / 10.0::DOUBLE AS media_por_dia
FROM (SELECT "Data_Abertura", {KIND} AS tipo_dia, count(*) AS v FROM silver GROUP BY ALL)
GROUP BY tipo_dia""")

CALENDAR = """SELECT CAST(unnest(generate_series(
    date_trunc('year', min({at})), date_trunc('year', max({at})) + INTERVAL 1 YEAR
      - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d FROM {source}"""
add("calendar_padded", BRONZE, f"""SELECT d AS "Date", CAST(year(d) AS INT) AS "Ano",
  CAST(month(d) AS INT) AS "MonthNo", monthname(d) AS "Mes", CAST(quarter(d) AS INT) AS "QuarterNo",
  'Qtr ' || CAST(quarter(d) AS VARCHAR) AS "Trimestre", CAST(day(d) AS INT) AS "Dia"
FROM ({CALENDAR.format(at='"Aberto"', source='bronze')})""")
add("date_rollup", DIMS, """SELECT ano, trimestre, mes, dia,
  CAST(grouping(ano, trimestre, mes, dia) AS INT) AS nivel, count(*) AS tickets,
  CAST(sum(target_risco_sla) AS BIGINT) AS target_risco_sla,
  CAST(sum(score_risco_operacional) AS BIGINT) AS score_risco_operacional,
  CAST(sum(duracao_segundos) AS BIGINT) AS duracao_segundos
FROM (SELECT CAST(year(aberto_at) AS INT) AS ano, CAST(quarter(aberto_at) AS INT) AS trimestre,
        CAST(month(aberto_at) AS INT) AS mes, CAST(day(aberto_at) AS INT) AS dia, * FROM fct)
GROUP BY ROLLUP (ano, trimestre, mes, dia)""")
add("role_date_join", DIMS, " UNION ALL ".join(
    f"""SELECT '{role}' AS role, CAST(year(d) AS INT) AS "Ano", CAST(month(d) AS INT) AS "MonthNo",
  count({col}) AS tickets, count(DISTINCT d) AS days
FROM ({CALENDAR.format(at=col, source='fct')}) c LEFT JOIN fct ON CAST({col} AS DATE) = d
GROUP BY ALL"""
    for role, col in (("aberto", "aberto_at"), ("resolvido", "resolvido_at"),
                      ("encerrado", "encerrado_at"))
))
add("next_seven_days", DAILY, """SELECT ds,
  CASE WHEN dayofweek(ds) IN (0, 6) THEN 1 ELSE 0 END AS fim_de_semana, taxa_violacao
FROM (SELECT CAST(unnest([max(data_abertura) + CAST(i AS INT) FOR i IN range(1, 8)]) AS DATE) AS ds,
        round(avg(pct_violacao_sla), 6) AS taxa_violacao FROM daily)""")

# --- Volume, seasonality, bottlenecks, goals ---------------------------------------

WORK = "(SELECT * FROM silver WHERE \"Status\" <> 'Sem Intervenção')"
add("daily_total_vs_real", SILVER, """SELECT "Data_Abertura", count("Numero") AS volume_total,
  CAST(sum("Exige_Intervencao") AS BIGINT) AS esforco_real FROM silver GROUP BY 1""")
add("group_rate_top10", SILVER, f"""SELECT coalesce("Grupo_designado", 'Não Classificado') AS grupo,
  count("Duracao") AS total_chamados, CAST(sum("Target_Risco_SLA") AS BIGINT) AS violacoes,
  100.0::DOUBLE * sum("Target_Risco_SLA") / count("Duracao") AS taxa_violacao
FROM {WORK} GROUP BY 1 HAVING count("Duracao") > 50 ORDER BY 4 DESC, 1 LIMIT 10""")
add("monthly_trend", SILVER, f"""SELECT "Ano_Mes" AS ano_mes, count("Duracao") AS total_incidentes,
  CAST(sum("Target_Risco_SLA") AS BIGINT) AS violados,
  100.0::DOUBLE * sum("Target_Risco_SLA") / count("Duracao") AS taxa_violacao
FROM {WORK} GROUP BY 1""")
add("volume_weekday", SILVER, """SELECT CAST((dayofweek("Aberto") + 6) % 7 AS INT)
    AS dia_semana_num,
  ['Domingo', 'Segunda', 'Terca', 'Quarta', 'Quinta', 'Sexta', 'Sabado'][dayofweek("Aberto") + 1]
    AS nome_dia, count(*) AS total_incidentes FROM silver GROUP BY 1, 2""")
add("volume_hour", SILVER, f"""SELECT CAST(hour("Aberto") AS INT) AS hora,
  count(*) AS total_incidentes FROM {WORK} GROUP BY 1""")
add("value_share", BRONZE, " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", "{c}" AS value, count(*) AS tickets,
  100.0::DOUBLE * count(*) / (SELECT count(*) FROM bronze WHERE "Resolvido" IS NULL) AS share
FROM bronze WHERE "Resolvido" IS NULL GROUP BY ALL"""
    for c in ("Status", "Aberto_por", "Prioridade")
))
add("target_share", BASE, f"""SELECT target_risco_sla, n AS total_tickets,
  {ROUND2.format(a='100 * n', b='(SELECT count(*) FROM base)')} AS percentual
FROM (SELECT target_risco_sla, count(*) AS n FROM base GROUP BY 1)""")
add("top_categories", BASE, """SELECT subcategoria, count(*) AS tickets FROM base GROUP BY 1
ORDER BY 2 DESC, 1 LIMIT 15""")
add("preview", SILVER, """SELECT "Numero", "Prioridade", "Aberto", "Status" FROM silver
ORDER BY "Aberto", "Numero" LIMIT 10""")
add("longest_per_group", BASE, """SELECT grupo_designado, incident_id, duracao_segundos,
  prioridade_num FROM base
QUALIFY row_number() OVER (PARTITION BY grupo_designado
  ORDER BY duracao_segundos DESC, incident_id DESC) = 1""")

BRONZE_NAMES = [
    "Numero", "Prioridade", "Produto", "Categoria", "Subcategoria", "Grupo_designado",
    "Item_de_configuracao", "Aberto", "Resolvido", "Encerrado", "Duracao", "Codigo_de_fechamento",
    "Descricao_resumida", "Solucao", "Aberto_por", "Incidente_Pai", "Status", "Entrou_para_KPI",
    "KPI_Violado",
]
add("completeness", BRONZE, " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) - count("{c}") AS nulls, count(*) AS tickets,
  100.0::DOUBLE * count("{c}") / count(*) AS filled FROM bronze""" for c in BRONZE_NAMES
))


def corr_pairs(columns, cell, source):
    return " UNION ALL ".join(
        f"""SELECT '{a}' AS a, '{b}' AS b,
  round(corr({cell.format(c=a)}, {cell.format(c=b)}), 6) AS r FROM {source}"""
        for i, a in enumerate(columns) for b in columns[i + 1:]
    )


add("nullity_corr", BRONZE, corr_pairs(
    ["Produto", "Categoria", "Subcategoria", "Grupo_designado", "Item_de_configuracao",
     "Resolvido", "Codigo_de_fechamento", "Solucao", "Incidente_Pai", "KPI_Violado"], 'CASE WHEN "{c}" IS NULL THEN 1.0::DOUBLE ELSE 0.0 END', "bronze"))
CAUSES = ["prioridade_num", "hora_abertura", "dia_semana_num", "fora_horario_comercial",
          "abriu_fim_de_semana", "mes_abertura", "trimestre", "possui_pai", "triagem_incompleta"]
add("numeric_corr", BASE, corr_pairs(CAUSES, "{c}::DOUBLE", "base"))
add("duration_summary", BASE, " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS n, min({c}) AS min, max({c}) AS max,
  round(avg({c}), 6) AS mean, round(quantile_cont({c}, 0.25), 6) AS p25,
  round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.75), 6) AS p75 FROM base"""
    for c in ("duracao_horas", "horas_ate_resolucao")
))
add("series_summary", DAILY, """SELECT min(data_abertura) AS primeira_data,
  max(data_abertura) AS ultima_data, count(DISTINCT data_abertura) AS dias,
  CAST(sum(total_chamados) AS BIGINT) AS chamados,
  CAST(sum(total_violacoes_sla) AS BIGINT) AS violacoes FROM daily""")
add("ticket_summary", SILVER, """SELECT count(*) AS total, count(DISTINCT "Numero") AS distinct_keys,
  min("Aberto") AS first_at, max("Aberto") AS last_at FROM silver""")
add("load_profile", SILVER, """SELECT 'month' AS section, "Ano_Mes" AS item,
  CAST(count(*) AS VARCHAR) AS value FROM silver GROUP BY 2
UNION ALL SELECT 'table', 'rows', CAST(count(*) AS VARCHAR) FROM silver
UNION ALL SELECT 'table', 'first_day', CAST(min("Data_Abertura") AS VARCHAR) FROM silver
UNION ALL SELECT 'table', 'last_day', CAST(max("Data_Abertura") AS VARCHAR) FROM silver
UNION ALL SELECT 'table', 'null_numero', CAST(count(*) - count("Numero") AS VARCHAR) FROM silver
UNION ALL SELECT 'table', 'null_data', CAST(count(*) - count("Data_Abertura") AS VARCHAR)
FROM silver""")
add("filtered_counts", SILVER, """SELECT count(*) FILTER ("Numero" IS NULL) AS null_numero,
  count(*) FILTER ("Data_Abertura" IS NULL) AS null_data,
  count(*) FILTER ("Resolvido" IS NULL) AS null_resolvido,
  count(*) FILTER ("Grupo_designado" IS NULL) AS null_grupo FROM silver""")
add("cardinality", BASE, " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS distinct_values FROM base"""
    for c in ("grupo_designado", "categoria", "subcategoria", "produto", "turno_abertura")
))
LABELLED = BASE + """,
labelled AS (
  SELECT *, ['A', 'B', 'C', 'D'][prioridade_num % 4 + 1] AS cluster_label FROM base
)"""
add("resolution_rate", LABELLED, """SELECT cluster_label, count(*) AS tickets,
  100.0::DOUBLE * sum(excedeu_tempo_esperado) / count(*) AS rate FROM labelled GROUP BY 1""")
add("grid_pivot", BASE, """SELECT prioridade_num,
  max(duracao_horas) FILTER (turno_abertura = 'Manha') AS "Manha",
  max(duracao_horas) FILTER (turno_abertura = 'Tarde') AS "Tarde",
  max(duracao_horas) FILTER (turno_abertura = 'Noite') AS "Noite",
  max(duracao_horas) FILTER (turno_abertura = 'Madrugada') AS "Madrugada"
FROM base GROUP BY 1""")
add("goal_tracking", SILVER + """,
goals(p, vl, vh, tl, th) AS (VALUES (2, 36, 39, 5389, 6168), (3, 231, 263, 22117, 22524)),
edge AS (SELECT max("Data_Abertura") AS d FROM silver)""",
    """SELECT ano, p AS prioridade_num, n AS chamados, v AS violacoes,
  CASE WHEN v < vl THEN 'abaixo' WHEN v > vh THEN 'acima' ELSE 'dentro' END AS meta_violacoes,
  CASE WHEN n < tl THEN 'abaixo' WHEN n > th THEN 'acima' ELSE 'dentro' END AS meta_volume,
  (v * days) / seen::DOUBLE AS violacoes_projetadas,
  (n * days) / seen::DOUBLE AS chamados_projetados
FROM (SELECT *, make_date(ano, 12, 31) - make_date(ano, 1, 1) + 1 AS days,
        least(make_date(ano, 12, 31), (SELECT d FROM edge)) - make_date(ano, 1, 1) + 1 AS seen
      FROM (SELECT CAST(year("Data_Abertura") AS INT) AS ano, "Prioridade_Num" AS p, count(*) AS n,
              CAST(sum("Target_Risco_SLA") AS BIGINT) AS v FROM silver GROUP BY 1, 2)
      JOIN goals USING (p))""")
add("parent_children", SILVER, """SELECT c."Incidente_Pai" AS parent_id, count(*) AS children,
  CAST(sum(c."Exige_Intervencao") AS BIGINT) AS children_with_work,
  any_value(p."Status") AS parent_status, any_value(p."Prioridade_Num") AS parent_priority
FROM silver c LEFT JOIN silver p ON p."Numero" = c."Incidente_Pai"
WHERE c."Possui_Pai" = 1 GROUP BY 1""")
BIN = """CAST(least(floor((duracao_segundos - lo)::DOUBLE * {n} / (hi - lo)), {n} - 1) AS INT)"""
HIST = """(SELECT *, min(duracao_segundos) OVER () AS lo, max(duracao_segundos) OVER () AS hi
  FROM base)"""
add("histogram", BASE, f"""SELECT {BIN.format(n=30)} AS bin, count(*) AS tickets FROM {HIST}
GROUP BY 1""")
add("histogram_by_class", BASE, f"""SELECT excedeu_tempo_esperado, {BIN.format(n=50)} AS bin,
  count(*) AS tickets FROM {HIST} GROUP BY 1, 2""")
add("boxplot_stats", LABELLED, """SELECT cluster_label, count(*) AS n, round(any_value(q1), 6) AS q1,
  round(any_value(q2), 6) AS median, round(any_value(q3), 6) AS q3,
  min(h) FILTER (h BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
  max(h) FILTER (h BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
  count(*) FILTER (NOT h BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
FROM (SELECT cluster_label, horas_ate_resolucao AS h FROM labelled
      WHERE horas_ate_resolucao IS NOT NULL)
JOIN (SELECT cluster_label, quantile_cont(horas_ate_resolucao, 0.25) AS q1,
        quantile_cont(horas_ate_resolucao, 0.5) AS q2,
        quantile_cont(horas_ate_resolucao, 0.75) AS q3 FROM labelled GROUP BY 1)
  USING (cluster_label)
GROUP BY 1""")
add("drift_psi", BASE, " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, bin, early, late, round((q - p) * ln(q / p), 9) AS psi
FROM (SELECT *, greatest(early / (sum(early) OVER ())::DOUBLE, 1e-6) AS p,
        greatest(late / (sum(late) OVER ())::DOUBLE, 1e-6) AS q
      FROM (SELECT CAST({c} AS VARCHAR) AS bin,
              count(*) FILTER (data_abertura < DATE '1999-01-01') AS early,
              count(*) FILTER (data_abertura >= DATE '1999-01-01') AS late
            FROM base GROUP BY 1))"""
    for c in ("score_risco_operacional", "hora_abertura", "grupo_designado")
))

# --- Compliance ------------------------------------------------------------------------

AUDIT = SILVER + """,
late AS (
  SELECT *, "Prioridade_Num" AS p, "KPI_Status_Int" AS k, "Duracao_Horas" >
    CASE "Prioridade_Num" WHEN 1 THEN 4 WHEN 2 THEN 4 WHEN 3 THEN 12 WHEN 4 THEN 24
      WHEN 5 THEN 96 END AS over
  FROM silver WHERE "Exige_Intervencao" = 1
),
audit AS (
  SELECT *, CASE
    WHEN "Possui_Pai" = 1 OR "Status" = 'Sem Intervenção' THEN
      CASE WHEN k = 1 THEN 'Elegibilidade: Erro (KPI em Incidente Pai/Sem Interv)'
           ELSE 'Fora do KPI (Isento por regra)' END
    WHEN p NOT BETWEEN 1 AND 5 THEN 'OK (Conforme)'
    WHEN over AND k = 0 THEN 'SLA: Falso Negativo (P' || p || ')'
    WHEN NOT over AND k = 1 THEN 'SLA: Falso Positivo (P' || p || ')'
    WHEN k = -1 THEN CASE WHEN p <= 3 THEN 'SLA: Sem Registro (P' || p || ')'
                          ELSE 'Fora do KPI (P4/P5 sem medição estrita)' END
    ELSE 'OK (Conforme)' END AS resultado
  FROM late
)"""
add("compliance_audit", AUDIT, "SELECT resultado, count(*) AS tickets FROM audit GROUP BY 1")
add("audit_labels", AUDIT, 'SELECT "Numero", resultado FROM audit')
add("weekend_crossing", AUDIT, """SELECT resultado, count(*) AS tickets, count(*) FILTER (x)
    AS crossed, 100.0::DOUBLE * count(*) FILTER (x) / count(*) AS pct_crossed
FROM (SELECT resultado, isodow("Aberto") >= 5 OR isodow("Encerrado") >= 6
        OR epoch_us("Encerrado") - epoch_us("Aberto") >= 172800000000 AS x FROM audit)
GROUP BY 1""")
# Weekdays counted one by one, against the closed form of the Spark side.
WORKDAYS = """len(list_filter(range(0, greatest(c - o, 0)), lambda i: isodow(o + CAST(i AS INT)) < 6))"""
add("business_hours", AUDIT, f"""SELECT resultado, count(*) AS tickets,
  sum(us)::BIGINT / 3.6e9::DOUBLE / count(*) AS horas_24x7,
  sum({WORKDAYS})::BIGINT * 8 / count(*)::DOUBLE AS horas_8x5
FROM (SELECT resultado, epoch_us("Encerrado") - epoch_us("Aberto") AS us,
        CAST("Aberto" AS DATE) AS o, CAST("Encerrado" AS DATE) AS c FROM audit) GROUP BY 1""")
add("business_days", SILVER, f"""SELECT "Numero", CAST({WORKDAYS} AS BIGINT) AS dias_uteis
FROM (SELECT "Numero", CAST("Aberto" AS DATE) AS o, CAST("Encerrado" AS DATE) AS c FROM silver)""")

# --- Data quality -------------------------------------------------------------------------

DIM_NAMES = ["dim_abertura", "dim_grupo", "dim_prioridade", "dim_produto_categoria", "dim_status",
             "dim_tempo"]


def unique_row(table, source, key):
    return f"""SELECT '{table}' AS "table", '{key}' AS "column", 'unique' AS "rule",
  (SELECT count(*) FROM (SELECT {key} FROM {source} WHERE {key} IS NOT NULL GROUP BY 1
    HAVING count(*) > 1)) AS violations"""


def rule_row(table, source, column, rule, broken):
    return f"""SELECT '{table}' AS "table", '{column}' AS "column", '{rule}' AS "rule",
  count(*) FILTER ({broken}) AS violations FROM {source}"""


def null_row(table, source, column):
    return rule_row(table, source, column, "not_null", f'"{column}" IS NULL')


def union(parts):
    return "\nUNION ALL ".join(parts)


add("quality_unique", DIMS, union(
    [unique_row(d, d, f"{d}_sk") for d in DIM_NAMES]
    + [unique_row("fct_incidents", "fct", "incident_sk")]))
KEY_SOURCES = ["Numero", "Produto", "Categoria", "Subcategoria", "Grupo_designado",
               "Data_Abertura", "Status", "Codigo_de_fechamento", "Entrou_para_KPI", "Prioridade",
               "Prioridade_Num", "Aberto"]
add("quality_not_null", DIMS, union(
    [null_row("silver", "silver", c) for c in (
        "Numero", "Prioridade_Num", "Duracao_Horas", "Target_Risco_SLA", "Data_Abertura")]
    + [null_row(d, d, f"{d}_sk") for d in DIM_NAMES]
    + [null_row("fct_incidents", "fct", "incident_sk")]
    + [null_row("silver_keys", "silver", c) for c in KEY_SOURCES]))
add("quality_models", DAILY, union([
    unique_row("ml_base_features", "base", "incident_id"),
    null_row("ml_base_features", "base", "incident_id"),
    null_row("ml_base_features", "base", "data_abertura"),
    unique_row("ml_forecast_dataset", "daily", "data_abertura"),
    null_row("ml_forecast_dataset", "daily", "data_abertura"),
    unique_row("ml_sla_classification_dataset", "base", "incident_id"),
    null_row("ml_sla_classification_dataset", "base", "incident_id"),
    rule_row("ml_sla_classification_dataset", "base", "target_risco_sla", "accepted_values",
             "target_risco_sla NOT IN (0, 1)"),
    unique_row("ml_cluster_dataset", "base", "incident_id"),
    null_row("ml_cluster_dataset", "base", "incident_id"),
]))
add("quality_accepted", BRONZE, union([
    rule_row("labels", "labels", "quality", "accepted_values", "quality NOT IN (0, 1)"),
    rule_row("labels", "labels", "toxic", "accepted_values", "toxic NOT IN (0, 1)"),
    rule_row("bronze", "bronze", "Status", "accepted_values",
             "\"Status\" NOT IN ('Encerrado', 'Resolvido')"),
    rule_row("bronze", "bronze", "KPI_Violado", "accepted_values",
             "\"KPI_Violado\" NOT IN ('NAO')"),
]))
add("quality_orphans", DIMS, union(
    f"""SELECT 'fct_incidents' AS "table", '{d}_sk' AS "column", 'relationships' AS "rule",
  count(*) AS violations FROM fct WHERE NOT EXISTS (SELECT 1 FROM {d} d WHERE d.{d}_sk = fct.{d}_sk)"""
    for d in DIM_NAMES))


def range_rows(source):
    return union([
        rule_row("silver", source, "Exige_Intervencao", "accepted_values",
                 '"Exige_Intervencao" NOT IN (0, 1)'),
        rule_row("silver", source, "Prioridade_Num", "range",
                 '"Prioridade_Num" < 1 OR "Prioridade_Num" > 5'),
        rule_row("silver", source, "Duracao_Horas", "range", '"Duracao_Horas" < 0'),
        rule_row("silver", source, "KPI_Status_Int", "accepted_values",
                 '"KPI_Status_Int" NOT IN (-1, 0, 1)'),
        rule_row("silver", source, "Target_Risco_SLA", "accepted_values",
                 '"Target_Risco_SLA" NOT IN (0, 1)'),
    ])


add("quality_ranges", SILVER, range_rows("silver"))
add("quality_job_ranges", JOB, range_rows("job2"))
add("table_counts_union", DAILY, union(
    f"SELECT '{name}' AS tabela, count(*) AS total_linhas FROM {source}"
    for name, source in (
        ("ml_base_features", "base"), ("ml_sla_classification_dataset", "base"),
        ("ml_cluster_dataset", "base"), ("ml_forecast_dataset", "daily"))))
add("scalar_checks", DAILY, """SELECT
  (SELECT count(*) FROM base WHERE incident_id IS NULL) AS nulos_pk_base,
  (SELECT count(*) FROM base WHERE incident_id IS NULL) AS nulos_pk_classif,
  (SELECT count(*) FROM base WHERE incident_id IS NULL) AS nulos_pk_cluster,
  (SELECT count(*) FROM daily WHERE data_abertura IS NULL) AS nulos_pk_forecast,
  CAST(0 AS BIGINT) AS erros_placeholder_scaled, CAST(0 AS BIGINT) AS erros_placeholder_cluster_id""")
add("class_balance", SILVER, """SELECT "Target_Risco_SLA", n AS tickets,
  100.0::DOUBLE * n / (SELECT count(*) FROM silver) AS pct,
  ((SELECT count(*) FROM silver) - n) / (n + 1)::DOUBLE AS ratio
FROM (SELECT "Target_Risco_SLA", count(*) AS n FROM silver GROUP BY 1)""")
add("complete_rows", BRONZE, """SELECT "Numero", "Resolvido", "KPI_Violado" FROM bronze
WHERE "Resolvido" IS NOT NULL AND "KPI_Violado" IS NOT NULL""")

# --- Series ------------------------------------------------------------------------------

TEAMS = DAILY + """,
team_days AS (
  SELECT grupo_designado AS team, data_abertura AS ds, count(*) AS y FROM base
  WHERE grupo_designado IS NOT NULL GROUP BY 1, 2
),
long_teams AS (
  SELECT * FROM team_days WHERE team IN (
    SELECT team FROM team_days GROUP BY 1 HAVING count(*) >= 60)
),
all_days AS (
  SELECT 'all' AS team, data_abertura AS ds, total_chamados AS y FROM daily
)"""
FILLED = """
  SELECT team, CAST(ds AS DATE) AS ds, coalesce(y, 0) AS y
  FROM (SELECT team, CAST(unnest(generate_series(min(ds), max(ds), INTERVAL 1 DAY)) AS DATE) AS ds
        FROM {source} GROUP BY team)
  LEFT JOIN {source} USING (team, ds)"""
add("team_daily", TEAMS, "SELECT * FROM team_days")
add("lags_rolling", TEAMS, f"""SELECT team, ds, y, lag(y, 1) OVER w AS lag_1, lag(y, 7) OVER w AS lag_7,
  avg(y) OVER (PARTITION BY team ORDER BY ds ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS media_7d
FROM ({FILLED.format(source='team_days')}) WINDOW w AS (PARTITION BY team ORDER BY ds)""")
add("holdout_split", TEAMS, """SELECT team, ds, y,
  row_number() OVER (PARTITION BY team ORDER BY ds DESC) <= 30 AS is_test FROM long_teams""")
CUTOFFS = """,
series AS ({source}),
cutoffs AS (
  SELECT team, CAST(unnest([hi - 7 - CAST(30 * i AS INT) FOR i IN range(0, 2000)
      IF hi - 7 - CAST(30 * i AS INT) >= lo + 90]) AS DATE) AS cutoff
  FROM (SELECT team, min(ds) AS lo, max(ds) AS hi FROM series GROUP BY 1)
)"""
add("backtest_folds", TEAMS + CUTOFFS.format(
    source="SELECT * FROM long_teams UNION ALL SELECT * FROM all_days"),
    """SELECT team, cutoff, count(*) FILTER (ds <= cutoff) AS n_train,
  count(*) FILTER (ds > cutoff AND ds <= cutoff + 7) AS n_test
FROM cutoffs JOIN series USING (team) GROUP BY 1, 2""")
NAIVE = TEAMS + """,
marked AS (
  SELECT *, row_number() OVER (PARTITION BY team ORDER BY ds DESC) <= 30 AS is_test,
    dayofweek(ds) AS dow FROM long_teams
),
naive AS (
  SELECT m.team, m.ds, m.y, n.naive, n.weekday_mean FROM marked m
  LEFT JOIN (SELECT team, dow, arg_max(y, ds) AS naive, avg(y) AS weekday_mean FROM marked
             WHERE NOT is_test GROUP BY 1, 2) n USING (team, dow)
  WHERE m.is_test
)"""
add("seasonal_naive", NAIVE, "SELECT * FROM naive")
add("forecast_errors", NAIVE, """SELECT team, count(*) AS n, round(avg(abs(y - f) / y), 6) AS mape,
  round(avg(abs(y - f)), 6) AS mae, round(sqrt(avg((y - f) * (y - f))), 6) AS rmse,
  round(avg(abs(y - f) / (y + 1) * 100), 6) AS erro_pct
FROM (SELECT team, y, weekday_mean AS f FROM naive WHERE weekday_mean IS NOT NULL) GROUP BY 1""")
add("horizon_errors", TEAMS + CUTOFFS.format(source=FILLED.format(source="all_days")),
    """SELECT horizon, count(*) AS n, round(avg(rel), 6) AS mape_mean,
  round(stddev_samp(rel), 6) AS mape_std, round(sqrt(avg(d * d)), 6) AS rmse,
  round(avg(abs(d)), 6) AS mae
FROM (SELECT CAST(a.ds - cutoff AS INT) AS horizon, (a.y - b.y)::DOUBLE AS d,
        abs(a.y - b.y) / nullif(a.y, 0)::DOUBLE AS rel
      FROM cutoffs JOIN series a USING (team) JOIN series b ON b.ds = a.ds - 7
      WHERE a.ds > cutoff AND a.ds <= cutoff + 7) GROUP BY 1""")
add("mean_impute", DAILY + """,
x AS (
  SELECT data_abertura, CASE WHEN total_criticos > 0 THEN pct_violacao_sla END AS t FROM daily
)""", "SELECT data_abertura, round(coalesce(t, (SELECT avg(t) FROM x)), 6) AS taxa FROM x")

# --- Feature preparation --------------------------------------------------------------------

VOTE_COLUMNS = [
    "prioridade_num", "hora_abertura", "dia_semana_num", "fora_horario_comercial",
    "abriu_fim_de_semana", "mes_abertura", "trimestre", "possui_pai", "is_filho_de_problema",
    "triagem_incompleta", "duracao_horas", "horas_ate_resolucao", "foi_resolvido",
    "excedeu_tempo_esperado", "fechado_sem_tecnico", "target_risco_sla", "kpi_status_int",
    "score_risco_operacional",
]
VOTES = BASE + """,
quart AS (SELECT """ + ", ".join(
    f"quantile_cont({c}::DOUBLE, 0.25) AS {c}_q1, quantile_cont({c}::DOUBLE, 0.75) AS {c}_q3"
    for c in VOTE_COLUMNS) + """ FROM base),
voted AS (SELECT incident_id, """ + " + ".join(
    f"""CASE WHEN {c} < {c}_q1 - 1.5 * ({c}_q3 - {c}_q1)
      OR {c} > {c}_q3 + 1.5 * ({c}_q3 - {c}_q1) THEN 1 ELSE 0 END"""
    for c in VOTE_COLUMNS) + """ AS outlier_votes FROM base, quart)"""
add("iqr_vote", VOTES, "SELECT *, outlier_votes > 9 AS is_outlier FROM voted")
add("clean_plus_outliers", VOTES, """SELECT CASE WHEN outlier_votes > 18 * 0.15 THEN 'outlier'
  ELSE 'clean' END AS origem, count(*) AS tickets FROM voted GROUP BY 1""")
add("cyclic_enc", BASE, "SELECT incident_id, " + ", ".join(
    f"round({f}(2 * pi() * {c} / {p}), 9) AS {c}_{f}"
    for c, p in (("hora_abertura", 24), ("dia_semana_num", 7), ("mes_abertura", 12))
    for f in ("sin", "cos")) + " FROM base")
add("freq_enc", BASE, "SELECT incident_id, " + ", ".join(
    f"""coalesce(CASE WHEN {c} IS NOT NULL THEN count(*) OVER (PARTITION BY {c})
  / (SELECT count({c}) FROM base)::DOUBLE END, 0.0::DOUBLE) AS {c}"""
    for c in ("grupo_designado", "subcategoria", "produto")) + " FROM base")
add("onehot_levels", BASE, """SELECT "column", level, n, place FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY "column" ORDER BY n DESC, level) AS INT) AS place,
    count(*) OVER (PARTITION BY "column") AS levels
  FROM (""" + union(
    f"""SELECT '{c}' AS "column", coalesce({c}, 'unknown') AS level, count(*) AS n FROM base
    GROUP BY ALL""" for c in ("categoria", "turno_abertura", "subcategoria")) + """))
WHERE place <= CASE WHEN levels > 50 THEN 49 ELSE 50 END""")
add("standardise", BASE, "SELECT incident_id, " + ", ".join(
    f"""round(coalesce(({c} - (SELECT avg({c}) FROM base))
  / nullif((SELECT stddev_pop({c}) FROM base), 0), 0.0::DOUBLE), 6) AS {c}""" for c in CAUSES)
    + " FROM base")
HASH = "CAST('0x' || substr(md5(incident_id || '#42'), 1, 8) AS BIGINT) % 100"
add("minmax", BASE + f""",
train AS (SELECT * FROM base WHERE {HASH} >= 20)""", "SELECT incident_id, " + ", ".join(
    f"""({c} - (SELECT min({c}) FROM train))
  / ((SELECT max({c}) FROM train) - (SELECT min({c}) FROM train))::DOUBLE AS {c}"""
    for c in ("duracao_segundos", "hora_abertura")) + " FROM base")
add("numeric_fill", SILVER, """SELECT "Numero", coalesce((epoch_us("Resolvido")
  - epoch_us("Aberto")) / 3.6e9::DOUBLE, 0.0::DOUBLE) AS horas FROM silver""")
add("hash_split", BASE, f"SELECT incident_id, {HASH} < 20 AS is_test FROM base")
add("stratified_split", BASE, """SELECT incident_id, excedeu_tempo_esperado,
  row_number() OVER (PARTITION BY excedeu_tempo_esperado
    ORDER BY md5(incident_id || '#42'), incident_id)
    <= round(count(*) OVER (PARTITION BY excedeu_tempo_esperado) * 0.2) AS is_test FROM base""")
add("class_weights", BASE, """SELECT excedeu_tempo_esperado, n,
  (SELECT count(*) FROM base) / ((SELECT count(DISTINCT excedeu_tempo_esperado) FROM base)
    * n)::DOUBLE AS weight
FROM (SELECT excedeu_tempo_esperado, count(*) AS n FROM base GROUP BY 1)""")
add("zscore_flags", BASE + """,
m AS (SELECT avg(duracao_horas) AS mu, stddev_pop(duracao_horas) AS sd,
        quantile_cont(duracao_horas, 0.5) AS med FROM base),
d AS (SELECT quantile_cont(abs(duracao_horas - med), 0.5) AS mad FROM base, m),
z AS (SELECT incident_id, duracao_horas, (duracao_horas - mu) / sd AS z,
        0.6745::DOUBLE * (duracao_horas - med) / mad AS r FROM base, m, d)""",
    """SELECT incident_id, duracao_horas, round(z, 6) AS z, round(r, 6) AS robust_z,
  CASE WHEN abs(z) > 3 THEN 1 ELSE 0 END AS is_extreme,
  CASE WHEN abs(r) > 3 THEN 1 ELSE 0 END AS is_extreme_robust FROM z""")

# --- Evaluation ---------------------------------------------------------------------------------

SCORED = BASE + """,
scored AS (
  SELECT incident_id, grupo_designado, excedeu_tempo_esperado AS label,
    (score_risco_operacional * 86400 + hour(aberto_at) * 3600 + minute(aberto_at) * 60
      + second(aberto_at)) / 777600.0::DOUBLE AS score FROM base
),
grid AS (
  SELECT score AS threshold, CAST(sum(pos) OVER w AS BIGINT) AS tp,
    CAST(sum(neg) OVER w AS BIGINT) AS fp
  FROM (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY 1)
  WINDOW w AS (ORDER BY score DESC)
),
curve AS (
  SELECT threshold, tp, fp, tp / (tp + fp)::DOUBLE AS precision,
    tp / (SELECT sum(label) FROM scored)::DOUBLE AS recall FROM grid
),
curve2 AS (
  SELECT *, 2.0::DOUBLE * (precision * recall) / (precision + recall + 1e-10::DOUBLE) AS f1
  FROM curve
)"""
add("pr_curve", SCORED, "SELECT * FROM curve2")
add("pr_threshold", SCORED, """SELECT threshold, precision, recall, f1 FROM curve2
ORDER BY round(f1, 12) DESC, threshold LIMIT 1""")
add("roc_curve", SCORED, """SELECT threshold,
  fp / (SELECT sum(1 - label) FROM scored)::DOUBLE AS fpr, recall AS tpr FROM curve""")
# Mann-Whitney form from average ranks, against the running counts of the Spark side.
RANKS = """(SELECT {by}label, rank() OVER ({part}ORDER BY score)
    + (count(*) OVER (PARTITION BY {by}score) - 1) / 2.0::DOUBLE AS r FROM scored)"""
AUC = """CAST(sum(label) AS BIGINT) AS positives, CAST(sum(1 - label) AS BIGINT) AS negatives,
  round((sum(r) FILTER (label = 1) - sum(label) * (sum(label) + 1) / 2.0::DOUBLE)
    / (sum(label) * sum(1 - label)), 9) AS auc"""
add("roc_auc", SCORED, f"SELECT {AUC} FROM {RANKS.format(by='', part='')}")
add("roc_auc_by_group", SCORED, f"""SELECT grupo_designado, {AUC}
FROM {RANKS.format(by='grupo_designado, ', part='PARTITION BY grupo_designado ')} GROUP BY 1""")
add("confusion", SCORED, """SELECT tp, fp, fn, tn, (tp + tn) / (tp + fp + fn + tn)::DOUBLE AS accuracy,
  tp / (tp + fp)::DOUBLE AS precision, tp / (tp + fn)::DOUBLE AS recall,
  2 * tp / (2 * tp + fp + fn)::DOUBLE AS f1
FROM (SELECT count(*) FILTER (label = 1 AND score > 0.5) AS tp,
        count(*) FILTER (label = 0 AND score > 0.5) AS fp,
        count(*) FILTER (label = 1 AND NOT score > 0.5) AS fn,
        count(*) FILTER (label = 0 AND NOT score > 0.5) AS tn FROM scored)""")
add("alerts", SCORED, "SELECT * FROM scored WHERE score > 0.8")
EFFECTS = ["duracao_horas", "horas_ate_resolucao", "foi_resolvido", "excedeu_tempo_esperado",
           "fechado_sem_tecnico", "target_risco_sla", "score_risco_operacional"]
add("cluster_profile", LABELLED, "SELECT cluster_label, " + ", ".join(
    f"""round({c}, 6) AS {c},
  round(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER () + 1e-9), 6) AS {c}_norm"""
    for c in EFFECTS) + " FROM (SELECT cluster_label, " + ", ".join(
    f"avg({c}) AS {c}" for c in EFFECTS) + " FROM labelled GROUP BY 1)")
add("cluster_stats", LABELLED, union(
    f"""SELECT cluster_label, '{c}' AS "column", round(avg({c}), 6) AS mean,
  round(stddev_samp({c}), 6) AS std, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max
FROM labelled GROUP BY 1""" for c in EFFECTS))
add("cluster_balance", LABELLED, """SELECT cluster_label, n AS count, pct AS percentage,
  CASE WHEN pct > 10 AND pct < 40 THEN 'OK' ELSE 'CHECK' END AS status,
  CASE WHEN min(pct) OVER () > 10 AND max(pct) OVER () < 40 THEN 'EQUILIBRADO'
    WHEN min(pct) OVER () > 1 THEN 'MELHORADO' ELSE 'DEGENERADO' END AS overall
FROM (SELECT cluster_label, count(*) AS n,
        100.0::DOUBLE * count(*) / (SELECT count(*) FROM labelled) AS pct
      FROM labelled GROUP BY 1)""")

# --- Models -------------------------------------------------------------------------------------

add("metrics_skeleton", SILVER, """SELECT (SELECT max("Data_Abertura") FROM silver) AS data_metrica,
  unnest(['forecast_d1', 'forecast_d7', 'ola_risk', 'clustering']) AS modelo_tipo,
  NULL::DOUBLE AS mape, NULL::DOUBLE AS rmse, NULL::DOUBLE AS auc_roc, NULL::INT AS amostras,
  NULL::VARCHAR AS status""")

# --- Later additions ----------------------------------------------------------------------------

add("drift_means", BASE, union(
    f"""SELECT '{c}' AS feature, round(avg({c}) FILTER (NOT late), 6) AS mean_early,
  round(avg({c}) FILTER (late), 6) AS mean_late,
  round((avg({c}) FILTER (late) - avg({c}) FILTER (NOT late))
    / stddev_samp({c}) FILTER (NOT late), 6) AS shift
FROM (SELECT *, data_abertura >= DATE '1999-01-01' AS late FROM base)"""
    for c in ("duracao_horas", "score_risco_operacional", "prioridade_num")))
add("effect_join", LABELLED, "SELECT incident_id, cluster_label, " + ", ".join(EFFECTS)
    + " FROM labelled")
add("status_join_fanout", DIMS, """SELECT d.status, d.codigo_fechamento, d.entrou_kpi,
  count(*) AS joined_rows FROM fct f JOIN dim_status d USING (dim_status_sk) GROUP BY 1, 2, 3""")
BASE_AND_FACT = DIMS + BASE[len(SILVER):]
add("fct_cluster_id", BASE_AND_FACT, """SELECT incident_id, CAST(prioridade_num % 4 AS INT)
    AS cluster_pred, ['A', 'B', 'C', 'D'][prioridade_num % 4 + 1] AS cluster_label,
  f.incident_sk, f.dim_grupo_sk,
  md5(['A', 'B', 'C', 'D'][prioridade_num % 4 + 1]) AS dim_cluster_sk
FROM base JOIN fct f USING (incident_id)""")
add("dim_cluster", LABELLED, "SELECT md5(cluster_label) AS dim_cluster_sk, cluster_label, "
    + ", ".join(
    f"""round({c}, 6) AS {c},
  round(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER () + 1e-9), 6) AS {c}_norm"""
    for c in ("duracao_horas", "target_risco_sla")) + """ FROM (SELECT cluster_label,
  avg(duracao_horas) AS duracao_horas, avg(target_risco_sla) AS target_risco_sla
  FROM labelled GROUP BY 1)""")
add("fct_ola_risk", DIMS + SCORED[len(SILVER):], """SELECT incident_id, label AS y_real,
  CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS y_pred, score AS y_pred_proba, f.incident_sk,
  f.dim_tempo_sk, f.dim_grupo_sk, f.dim_prioridade_sk
FROM scored JOIN fct f USING (incident_id)""")

add("dim_modelo", BASE, """SELECT md5(modelo_tipo) AS dim_modelo_sk, modelo_tipo, algoritmo, alvo,
  CASE WHEN modelo_tipo LIKE 'forecast%' THEN days ELSE tickets END AS amostras_disponiveis, desde, ate
FROM (SELECT count(DISTINCT data_abertura) AS days, count(*) AS tickets,
    min(data_abertura) AS desde, max(data_abertura) AS ate FROM base), (VALUES
  ('forecast_d1', 'Seasonal regression', 'Volume diário'),
  ('forecast_d7', 'Seasonal regression', 'Volume diário'),
  ('ola_risk', 'Gradient-boosted trees', 'Tempo excedido (0/1)'),
  ('clustering', 'K-means (k=4)', 'Cluster A/B/C/D')) v(modelo_tipo, algoritmo, alvo)""")
add("risk_split_counts", BASE, """SELECT is_test, label, count(*) AS tickets FROM (
  SELECT excedeu_tempo_esperado AS label,
    row_number() OVER (PARTITION BY excedeu_tempo_esperado
      ORDER BY md5(incident_id || '#42'), incident_id)
      <= round(count(*) OVER (PARTITION BY excedeu_tempo_esperado) * 0.2) AS is_test FROM base)
GROUP BY 1, 2""")
add("risk_width", BASE, union(
    f"""SELECT '{c}' AS "column", count(DISTINCT coalesce({c}, 'unknown')) + 1 AS features FROM base"""
    for c in ("grupo_designado", "categoria", "subcategoria", "turno_abertura")))
add("iso_forest_counts", BASE, """SELECT count(*) AS tickets, count(*) AS scored,
  true AS within_share FROM base""")
add("cluster_counts", BASE, """SELECT count(*) AS tickets, count(DISTINCT incident_id) AS incidents,
  4::BIGINT AS labels, 0::BIGINT AS unlabelled FROM base""")
add("record_latest", BASE, """SELECT 'forecast_d1' AS model, ano_mes AS name,
  CAST(CASE WHEN even THEN violations ELSE volume END AS DOUBLE) AS value,
  CASE WHEN even THEN TIMESTAMP '2001-08-02 05:00:00' ELSE TIMESTAMP '2001-08-01 05:00:00' END AS at
FROM (SELECT ano_mes, CAST(substr(ano_mes, 6, 2) AS INT) % 2 = 0 AS even, count(*) AS volume,
    sum(target_risco_sla) AS violations FROM base GROUP BY 1, 2)""")
add("schema_differences", BRONZE, """SELECT 'bronze' AS source, count(*) AS tickets,
  '' AS missing, '' AS extra FROM bronze
UNION ALL SELECT 'cut', count(*), 'Status', 'extra' FROM bronze""")
add("contribution_check", BASE, """SELECT label, count(*) AS tickets, count(*) AS additive FROM (
  SELECT excedeu_tempo_esperado AS label,
    row_number() OVER (PARTITION BY excedeu_tempo_esperado
      ORDER BY md5(incident_id || '#42'), incident_id)
      <= round(count(*) OVER (PARTITION BY excedeu_tempo_esperado) * 0.2) AS is_test FROM base)
WHERE is_test GROUP BY 1""")
add("silver_two_loads", BRONZE, """SELECT strftime(opened, '%Y-%m') AS "Ano_Mes", count(*) AS tickets,
  count(DISTINCT n) AS numbers, CAST(sum(seconds) AS BIGINT) AS seconds FROM (
  SELECT n, CASE WHEN k % 101 = 0 AND NOT late THEN "Aberto" + INTERVAL 40 DAY ELSE "Aberto" END AS opened,
    CASE WHEN k % 7 = 0 AND (late OR k % 101 = 0) THEN "Duracao" + 60 ELSE "Duracao" END AS seconds
  FROM (SELECT "Numero" AS n, CAST(substr("Numero", 4) AS BIGINT) AS k, "Aberto", "Duracao",
          "Aberto" >= TIMESTAMP '1998-03-15' AS late FROM bronze))
GROUP BY 1""")
add("cv_selection_tickets", BASE, """SELECT CAST((place - cut - 1) % 5 AS INT) AS fold, count(*) AS tickets FROM (
  SELECT label, row_number() OVER (PARTITION BY label ORDER BY h, incident_id) AS place,
    round(count(*) OVER (PARTITION BY label) * 0.2) AS cut
  FROM (SELECT incident_id, excedeu_tempo_esperado AS label, md5(incident_id || '#42') AS h FROM base))
WHERE place > cut GROUP BY 1""")
add("root_children", SILVER, """SELECT root, CAST(depth AS BIGINT) AS depth, count(*) AS tickets,
  CAST(sum(w) AS BIGINT) AS with_work FROM (
  WITH RECURSIVE linked AS (
    SELECT "Numero" AS n, "Exige_Intervencao" AS w, CASE WHEN "Possui_Pai" = 1 THEN "Incidente_Pai"
      WHEN k > 1 THEN 'INC' || lpad(CAST(CASE WHEN k % 4 = 0 THEN 1 ELSE k // 2 END AS VARCHAR), 9, '0') END AS up
    FROM (SELECT *, CAST(substr("Numero", 4) AS BIGINT) AS k FROM silver)),
  walk(n, w, up, depth) AS (
    SELECT n, w, up, 1 FROM linked WHERE up IS NOT NULL
    UNION ALL SELECT walk.n, walk.w, linked.up, depth + 1 FROM walk JOIN linked ON linked.n = walk.up
    WHERE linked.up IS NOT NULL)
  SELECT n, max(w) AS w, arg_max(up, depth) AS root, max(depth) AS depth FROM walk GROUP BY n)
GROUP BY 1, 2""")
add("sla_clock", BRONZE, """SELECT "Numero" AS incident_id, "Aberto" AS opened, deadline, contract_hours FROM (
  SELECT *, "Aberto" + to_hours(contract_hours) AS deadline FROM (
    SELECT "Numero", "Aberto", "Resolvido", CAST(CASE substr("Prioridade", 1, 1)
      WHEN '1' THEN 4 WHEN '2' THEN 4 WHEN '3' THEN 12 WHEN '4' THEN 24 ELSE 96 END AS INT) AS contract_hours
    FROM bronze))
WHERE deadline <= (SELECT max(greatest("Aberto", coalesce("Resolvido", "Aberto"))) - INTERVAL 1 HOUR FROM bronze)
  AND ("Resolvido" IS NULL OR "Resolvido" > deadline)""")
