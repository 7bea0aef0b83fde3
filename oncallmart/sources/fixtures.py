"""Tickets derived from the test tables (see FIXTURES.md)."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oncallmart import schema as S

MIN_DATE = "1999-01-01"

# Columns of the test tables that the tickets need; given schemas spare a pass over the
# file footers.
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint",
    "customer": "c_custkey bigint, c_nationkey int",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def bronze(spark: SparkSession, folder: str) -> DataFrame:
    """One ticket per order, enriched from its customer and its lines.

    The right side of every left join is grouped by its join key, so Catalyst
    knows the key is unique and drops the join, scan and shuffle altogether when
    a query uses none of its columns.
    """
    orders = table(spark, folder, "orders")
    lines = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_partkey").alias("part_key"), F.min("l_suppkey").alias("supp_key")
    )
    customers = table(spark, folder, "customer").groupBy("c_custkey").agg(
        F.min("c_nationkey").alias("nation_key")
    )
    parts = table(spark, folder, "part").groupBy("p_partkey").agg(
        F.min_by("p_name", "p_partkey").alias("p_name"),
        F.min_by("p_type", "p_partkey").alias("p_type"),
        F.min_by("p_brand", "p_partkey").alias("p_brand"),
    )
    joined = (
        orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(parts, F.col("part_key") == F.col("p_partkey"), "left")
    )
    return joined.selectExpr("*", *STEPS).selectExpr(*TICKET)


# The mapping of FIXTURES.md, as SQL expressions over one order and its joined rows.
STEPS = [
    "o_orderkey AS k",
    "cast(substr(o_orderpriority, 1, 1) AS int) AS pn",
    "cast(pow(o_orderkey * 104729 % 600, 3) AS bigint) div 600 AS secs",
    "o_orderstatus = 'P' AS noise",
    "o_orderkey % 8 = 3 AS kid",
    "o_orderdate + make_dt_interval(0, 0, 0, o_orderkey * 7919 % 86400) AS opened",
]
IN_KPI = "(pn <= 3 AND NOT kid AND NOT noise)"
LATE = "secs > 3600 * element_at(map(1, 4, 2, 4, 3, 12, 4, 24, 5, 96), pn)"
TICKET = [
    "'INC' || lpad(cast(k AS string), 9, '0') AS Numero",
    "element_at(map(1, '1 - Crítica', 2, '2 - Alta', 3, '3 - Moderada', 4, '4 - Baixa', "
    "5, '5 - Muito Baixa'), pn) AS Prioridade",
    "p_brand AS Produto",
    "p_type AS Categoria",
    "p_name AS Subcategoria",
    "if(k % 97 <> 0, 'Team' || lpad(cast(nation_key + 1 AS string), 2, '0'), null) "
    "AS Grupo_designado",
    "'CI-' || cast(supp_key AS string) AS Item_de_configuracao",
    "opened AS Aberto",
    "if(noise, null, opened + make_dt_interval(0, 0, 0, secs * 4 div 5)) AS Resolvido",
    "opened + make_dt_interval(0, 0, 0, secs) AS Encerrado",
    "secs AS Duracao",
    "CASE WHEN noise THEN null WHEN k % 5 = 0 THEN 'Resolvido pelo Usuário' "
    "WHEN k % 5 = 1 THEN 'Sem Descrição' ELSE 'Sucesso' END AS Codigo_de_fechamento",
    "coalesce(p_name, 'Sem item') AS Descricao_resumida",
    "if(noise, null, 'Solucao ' || cast(k % 7 AS string)) AS Solucao",
    "if(noise, 'Monitoramento', 'User' || cast(o_custkey % 50 AS string)) AS Aberto_por",
    "if(kid, 'INC' || lpad(cast(k - 3 AS string), 9, '0'), null) AS Incidente_Pai",
    "CASE o_orderstatus WHEN 'F' THEN 'Encerrado' WHEN 'O' THEN 'Resolvido' "
    "ELSE 'Sem Intervenção' END AS Status",
    f"if({IN_KPI}, 'SIM', 'NAO') AS Entrou_para_KPI",
    f"if(k % 10 = 7, null, if({IN_KPI} AND k % 4 = 0 AND {LATE}, 'SIM', 'NAO')) AS KPI_Violado",
]


def raw_export(spark: SparkSession, folder: str) -> DataFrame:
    """The same tickets as a raw text export: accented headers, cells that cannot be read
    (`n/d`, `pendente`), decimal and exponent numbers, and dates in the other listed forms."""
    tickets = bronze(spark, folder)
    number = F.substring("Numero", 4, 9).cast("bigint")
    text = F.col("Duracao").cast("string")
    broken = {
        "Duracao": F.when(number % 13 == 0, "n/d")
        .when(number % 13 == 1, F.concat(text, F.lit(".0")))
        .when(number % 13 == 2, F.concat(text, F.lit("0e-1"))),
        "Resolvido": F.when(number % 17 == 0, "pendente")
        .when(number % 17 == 1, F.date_format("Resolvido", "dd/MM/yyyy HH:mm:ss"))
        .when(number % 17 == 2, F.date_format("Resolvido", "dd-MM-yyyy HH:mm:ss")),
    }
    cells = []
    for header, name in S.RAW_HEADERS.items():
        cell = F.col(name).cast("string")
        if name in broken:
            cell = F.coalesce(broken[name], cell)
        cells.append(cell.alias(header))
    return tickets.select(*cells, F.lit("x").alias("Coluna extra"))
