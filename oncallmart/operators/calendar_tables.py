"""Calendars, holidays and the joins that use them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oncallmart.functions import calendar as C

# --- Fixed values: national holidays with a fixed date (month, day, first year) ---
FIXED_HOLIDAYS = [
    (1, 1, 0, "Confraternização Universal"),
    (4, 21, 0, "Tiradentes"),
    (5, 1, 0, "Dia do Trabalhador"),
    (9, 7, 0, "Independência do Brasil"),
    (10, 12, 1980, "Nossa Senhora Aparecida"),
    (11, 2, 0, "Finados"),
    (11, 15, 0, "Proclamação da República"),
    (11, 20, 2024, "Dia Nacional de Zumbi e da Consciência Negra"),
    (12, 25, 0, "Natal"),
]


def years_of(frame: DataFrame, column: str) -> DataFrame:
    """Every year from the first to the last date of a column."""
    return frame.agg(
        F.min(F.year(column)).alias("first"), F.max(F.year(column)).alias("last")
    ).select(F.explode(F.sequence("first", "last")).alias("year"))


def holidays(years: DataFrame) -> DataFrame:
    """National holidays: about ten rows per year."""
    year = F.col("year")
    fixed = F.array(
        *[
            F.struct(
                F.when(year >= since, F.make_date(year, F.lit(month), F.lit(day))).alias("day"),
                F.lit(name).alias("name"),
            )
            for month, day, since, name in FIXED_HOLIDAYS
        ],
        F.struct(
            F.date_sub(C.easter_sunday(year), 2).alias("day"),
            F.lit("Sexta-feira Santa").alias("name"),
        ),
    )
    return years.select(F.inline(fixed)).where(F.col("day").isNotNull())


def padded_calendar(frame: DataFrame, column: str) -> DataFrame:
    """Every day from 1 January of the first year to 31 December of the last."""
    day = F.col("Date")
    return (
        frame.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
        .select(
            F.explode(
                F.sequence(
                    F.make_date(F.year("lo"), F.lit(1), F.lit(1)),
                    F.make_date(F.year("hi"), F.lit(12), F.lit(31)),
                )
            ).alias("Date")
        )
        .select(
            day,
            F.year(day).alias("Ano"),
            F.month(day).alias("MonthNo"),
            F.date_format(day, "MMMM").alias("Mes"),
            F.quarter(day).alias("QuarterNo"),
            F.concat(F.lit("Qtr "), F.quarter(day).cast("string")).alias("Trimestre"),
            F.day(day).alias("Dia"),
        )
    )


def drill_down(frame: DataFrame, at: str, measures: list[str]) -> DataFrame:
    """Sums along the date hierarchy year > quarter > month > day, at every level."""
    day = F.to_date(at)
    # One row per day first; the rollup then expands days, not tickets.
    daily = frame.groupBy(day.alias("day")).agg(
        F.count("*").alias("tickets"), *[F.sum(m).alias(m) for m in measures]
    )
    dated = daily.select(
        F.year("day").alias("ano"), F.quarter("day").alias("trimestre"),
        F.month("day").alias("mes"), F.day("day").alias("dia"), "tickets", *measures,
    )
    return dated.rollup("ano", "trimestre", "mes", "dia").agg(
        F.grouping_id().cast("int").alias("nivel"),
        F.sum("tickets").alias("tickets"),
        *[F.sum(m).alias(m) for m in measures],
    )


def by_date_role(facts: DataFrame, roles: dict[str, str]) -> DataFrame:
    """Monthly counts for each timestamp role, through that role's own calendar.

    One pass counts the days of all roles; the calendars and the join then meet
    one row per role and day.
    """
    pairs = F.array(
        *[F.struct(F.lit(r).alias("role"), F.to_date(c).alias("day")) for r, c in roles.items()]
    )
    days = facts.select(F.inline(pairs)).where(F.col("day").isNotNull()).groupBy(
        "role", "day"
    ).agg(F.count("*").alias("n"))
    first = F.make_date(F.year(F.min("day")), F.lit(1), F.lit(1))
    last = F.make_date(F.year(F.max("day")), F.lit(12), F.lit(31))
    calendar = days.groupBy("role").agg(F.sequence(first, last).alias("dates")).select(
        "role", F.explode("dates").alias("day")
    )
    return calendar.join(days, ["role", "day"], "left").groupBy(
        "role", F.year("day").alias("Ano"), F.month("day").alias("MonthNo")
    ).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tickets"), F.count("*").alias("days"))


def with_day_kind(frame: DataFrame, day: str, holiday_table: DataFrame) -> DataFrame:
    """Mark each row as holiday, weekend or working day."""
    days = holiday_table.select(F.col("day").alias("_holiday")).distinct()
    joined = frame.join(days, F.col(day) == F.col("_holiday"), "left")
    kind = C.day_kind(F.col("_holiday").isNotNull(), F.col(day))
    return joined.withColumn("tipo_dia", kind).drop("_holiday")


def next_days(daily: DataFrame, day: str = "data_abertura", rate: str = "pct_violacao_sla",
              horizon: int = 7) -> DataFrame:
    """The days after the last observed one, with the regressors of the forecast."""
    ahead = daily.agg(F.max(day).alias("last"), F.avg(rate).alias("taxa_violacao"))
    return (
        ahead.select(
            F.explode(
                F.sequence(F.date_add("last", 1), F.date_add("last", horizon))
            ).alias("ds"),
            "taxa_violacao",
        )
        .select("ds", C.weekend(F.col("ds")).alias("fim_de_semana"), "taxa_violacao")
    )
