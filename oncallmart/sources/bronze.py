"""From a raw export, or Bronze files, to typed Bronze tickets."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oncallmart import schema as S
from oncallmart.functions.tickets import said_yes

ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüçÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇ"
PLAIN = "aaaaaeeeeiiiiooooouuuucAAAAAEEEEIIIIOOOOOUUUUC"


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.BRONZE).parquet(path)


def read_export(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """A raw text export; every cell stays text until `coerce_types`.

    Set `multiline` only if cells hold line breaks: such a file is read by one task.
    """
    return spark.read.option("header", True).option("multiLine", multiline).csv(path)


def plain_name(header: str) -> str:
    """Header as an identifier: no accents, blanks or punctuation."""
    text = header.translate(str.maketrans(ACCENTED, PLAIN))
    words = "".join(c if c.isalnum() else " " for c in text).split()
    return "_".join(words)


def normalise_headers(frame: DataFrame) -> DataFrame:
    names = {h: S.RAW_HEADERS.get(h, plain_name(h)) for h in frame.columns}
    return frame.select([F.col(f"`{h}`").alias(n) for h, n in names.items()])


def keep_known(frame: DataFrame) -> DataFrame:
    return frame.select([c for c in S.BRONZE.names if c in frame.columns])


def as_text(frame: DataFrame) -> DataFrame:
    return frame.select([F.col(c).cast("string").alias(c) for c in frame.columns])


def _kpi_text(frame: DataFrame, name: str):
    if isinstance(frame.schema[name].dataType, T.BooleanType):
        return F.when(F.col(name), "SIM").when(~F.col(name), "NAO")
    return F.col(name).cast("string")


# Forms of a date and time in exports, besides the ISO one; day first.
DATE_FORMATS = [
    "dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy HH:mm", "dd/MM/yyyy", "dd-MM-yyyy HH:mm:ss",
    "dd-MM-yyyy HH:mm", "dd-MM-yyyy",
]


def parsed(name: str, source: T.DataType, target: T.DataType) -> Column:
    """A cell as its Bronze type, or null.

    Whole numbers may be written with decimals or an exponent (`3600.0`, `1.5e3`); a true
    fraction is rounded. Dates may be in any of the listed forms.
    """
    cell = F.col(name)
    if not isinstance(source, T.StringType):
        return cell.try_cast(target)
    if isinstance(target, T.IntegralType):
        return F.coalesce(cell.try_cast(target), F.round(cell.try_cast("decimal(38,9)")).try_cast(target))
    if isinstance(target, T.TimestampNTZType):
        others = [F.try_to_timestamp(cell, F.lit(f)).cast(target) for f in DATE_FORMATS]
        return F.coalesce(cell.try_cast(target), *others)
    return cell.try_cast(target)


def lost_cells(raw: DataFrame) -> DataFrame:
    """Filled cells that no rule could read, per column: (column, lost)."""
    named = keep_known(normalise_headers(raw))
    typed = [f.name for f in S.BRONZE if f.name in named.columns and not isinstance(f.dataType, T.StringType)]
    counts = [
        F.struct(
            F.lit(c).alias("column"),
            F.count_if(
                (F.trim(F.col(c).cast("string")) != "")
                & parsed(c, named.schema[c].dataType, S.BRONZE[c].dataType).isNull()
            ).alias("lost"),
        )
        for c in typed
    ]
    return named.agg(F.array(*counts).alias("r")).select(F.inline("r"))


def coerce_types(frame: DataFrame) -> DataFrame:
    """Every column as its Bronze type; cells that do not parse become null (`lost_cells`
    counts them)."""
    columns = []
    for field in S.BRONZE:
        if field.name not in frame.columns:
            continue
        if field.name in ("Entrou_para_KPI", "KPI_Violado"):
            value = _kpi_text(frame, field.name)
        else:
            value = parsed(field.name, frame.schema[field.name].dataType, field.dataType)
        columns.append(value.alias(field.name))
    return frame.select(columns)


def kpi_flags(frame: DataFrame) -> DataFrame:
    """Both KPI columns as booleans, through the yes/no words (null stays null)."""
    named = {c: _kpi_text(frame, c) for c in ("Entrou_para_KPI", "KPI_Violado")}
    return frame.withColumns(
        {c: F.when(text.isNotNull(), said_yes(text)) for c, text in named.items()}
    )


def load_export(frame: DataFrame) -> DataFrame:
    return coerce_types(keep_known(normalise_headers(frame)))
