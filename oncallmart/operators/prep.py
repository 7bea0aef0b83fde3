"""Preparing features: outliers, encodings, scaling, splits and weights."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oncallmart import schema as S
from oncallmart.functions import numeric as N
from oncallmart.operators import joins, ordered
from oncallmart.session import settle

IQR_COLUMNS = [
    "prioridade_num", "hora_abertura", "dia_semana_num", "fora_horario_comercial",
    "abriu_fim_de_semana", "mes_abertura", "trimestre", "possui_pai", "is_filho_de_problema",
    "triagem_incompleta", "duracao_horas", "horas_ate_resolucao", "foi_resolvido",
    "excedeu_tempo_esperado", "fechado_sem_tecnico", "target_risco_sla", "kpi_status_int",
    "score_risco_operacional",
]


def iqr_fences(frame: DataFrame, columns: list[str] = IQR_COLUMNS) -> dict[str, tuple]:
    """Fit: the limits 1.5 IQR beyond the quartiles, two numbers per column."""
    reach = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    fitted = ordered.quantiles(frame, columns, {"q1": 0.25, "q3": 0.75}).select(
        "column", (F.col("q1") - reach).alias("lo"), (F.col("q3") + reach).alias("hi")
    )
    return {row["column"]: (row["lo"], row["hi"]) for row in fitted.collect()}


def iqr_votes(frame: DataFrame, fences: dict[str, tuple], share: float = 0.5) -> DataFrame:
    """Count the columns in which a row lies outside its fence; mark it above the share.

    A missing value is not an outlier, and the empty placeholders do not vote.
    """
    votes = F.lit(0)
    for column, (low, high) in sorted(fences.items()):
        inside = F.col(column).cast("double").between(low, high)
        votes = votes + F.when(~inside, 1).otherwise(0)
    return frame.withColumn("outlier_votes", votes).withColumn(
        "is_outlier", F.col("outlier_votes") > len(fences) * share
    )


def split_outliers(voted: DataFrame) -> tuple[DataFrame, DataFrame]:
    return voted.where(~F.col("is_outlier")), voted.where("is_outlier")


def cyclic(frame: DataFrame, cycles: dict[str, int] = S.CYCLES) -> DataFrame:
    """Replace each cyclic column by its sine and cosine."""
    added = {}
    for column, period in cycles.items():
        added[f"{column}_sin"], added[f"{column}_cos"] = N.cycle(F.col(column), period)
    return frame.withColumns(added).drop(*cycles)


def _levels(frame: DataFrame, columns: list[str], missing: str | None = None) -> DataFrame:
    """Rows per (column, level) for several text columns, in one pass."""
    def level(c: str):
        text = F.col(c).cast("string")
        return F.coalesce(text, F.lit(missing)) if missing else text

    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), level(c).alias("level")) for c in columns]
    )
    return (
        frame.select(F.inline(pairs)).where(F.col("level").isNotNull())
        .groupBy("column", "level").agg(F.count("*").alias("n"))
    )


def frequencies(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Share of each level among the rows that have a value: column, level, share."""
    counts = settle(_levels(frame, columns))
    totals = counts.groupBy("column").agg(F.sum("n").alias("total"))
    return counts.join(totals, "column").select(
        "column", "level", (F.col("n") / F.col("total")).alias("share")
    )


def frequency_encode(frame: DataFrame, fitted: DataFrame, columns: list[str]) -> DataFrame:
    """Swap each level for its share; unseen and missing levels become 0.

    The level table grows with the data, so the planner picks each join by the
    measured size of the column's part.
    """
    out = frame
    for column in columns:
        shares = fitted.where(F.col("column") == column).select(
            F.col("level").alias(column), F.col("share").alias("_share")
        )
        out = out.join(shares, column, "left").withColumn(
            column, F.coalesce("_share", F.lit(0.0))
        ).drop("_share")
    return out


def numbered_levels(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Every level of every column, null counted as 'unknown', with its place by frequency;
    levels of one frequency are in the order of their hash.

    Frequencies are few, whatever the number of levels: each takes the places after those of
    the larger ones, and the levels of one frequency are placed by hash prefix, so no task
    ranks all levels of a column.
    """
    counts = settle(_levels(frame, columns, missing="unknown")) if columns else frame.sparkSession.createDataFrame(
        [], "column string, level string, n bigint"
    )
    same = F.concat_ws("#", "n", "column")
    placed = _places(counts.withColumn("_same", same), "_same", "level", 0)
    sizes = counts.groupBy("column", "n").agg(F.count("*").alias("levels")).withColumn("order", -F.col("n"))
    starts = ordered.running_sums(sizes, "order", ["levels"], ["column"]).select("column", "n", "levels_before")
    return placed.join(starts, ["column", "n"]).select(
        "column", "level", "n", (F.col("levels_before") + F.col("_place") - 1).cast("int").alias("place")
    )


def one_hot_levels(frame: DataFrame, columns: list[str], cap: int = 50) -> DataFrame:
    """The levels kept per column: the most frequent ones, null counted as 'unknown'.

    With more than `cap` levels the last place is for all the others together.
    """
    counts = _levels(frame, columns, missing="unknown")
    sizes = counts.groupBy("column").agg(F.count("*").alias("levels"))
    # Ranked against the literal cap, Spark keeps a top-k per task before the shuffle.
    ranked = counts.withColumn(
        "place",
        F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n"), "level")),
    ).where(F.col("place") <= cap)
    keep = F.when(F.col("levels") > cap, cap - 1).otherwise(cap)
    return (
        ranked.join(sizes, "column")
        .where(F.col("place") <= keep)
        .select("column", "level", "n", "place")
    )


def standardise(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Zero mean and unit population deviation; a constant column becomes 0."""
    stats = frame.agg(
        F.struct(
            *[F.avg(c).alias(f"{c}_m") for c in columns],
            *[F.stddev_pop(c).alias(f"{c}_s") for c in columns],
        )
    ).scalar()
    scaled = {
        c: F.coalesce(
            (F.col(c) - F.col(f"_s.{c}_m")) / F.nullif(F.col(f"_s.{c}_s"), F.lit(0.0)),
            F.lit(0.0),
        )
        for c in columns
    }
    return frame.withColumn("_s", stats).withColumns(scaled).drop("_s")


def min_max(frame: DataFrame, columns: list[str], train: str) -> DataFrame:
    """Scale to 0..1 by the limits of the training rows only."""
    limits = frame.where(F.col(train)).agg(
        F.struct(
            *[F.min(c).alias(f"{c}_lo") for c in columns],
            *[F.max(c).alias(f"{c}_hi") for c in columns],
        )
    ).scalar()
    scaled = {
        c: (F.col(c) - F.col(f"_s.{c}_lo"))
        / F.nullif(F.col(f"_s.{c}_hi") - F.col(f"_s.{c}_lo"), F.lit(0))
        for c in columns
    }
    return frame.withColumn("_s", limits).withColumns(scaled).drop("_s")


def zero_filled(frame: DataFrame, columns: list[str]) -> DataFrame:
    return frame.na.fill(0, columns)


def split_of(frame: DataFrame, identifier: str = "incident_id", test: int = 20,
             seed: int = 42) -> DataFrame:
    """Mark a stable share of the rows as test data, from the identifier alone.

    A hash draws the same share from every class up to chance, on any number of
    rows and partitions, with no shuffle.
    """
    return frame.withColumn("is_test", N.hash_percent(F.col(identifier), seed) < test)


def _places(frame: DataFrame, label: str, identifier: str, seed: int) -> DataFrame:
    """Place of each row in the hash order of its class, and the size of the class.

    The order is kept per hash prefix, so the largest class is ranked by many
    tasks and not by one.
    """
    marked = frame.withColumn("_rank", N.hash_rank(F.col(identifier), seed)).withColumn(
        "_prefix", F.substring("_rank", 1, 4)
    )
    sizes = marked.groupBy(label, "_prefix").agg(F.count("*").alias("_n"))
    classes = Window.partitionBy(label)
    earlier = classes.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        label, "_prefix",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(classes).alias("_size"),
    )
    inside = Window.partitionBy(label, "_prefix").orderBy("_rank", identifier)
    placed = joins.null_safe_join(marked, offsets, [label, "_prefix"])
    return placed.withColumn("_place", F.col("_before") + F.row_number().over(inside)).drop(
        "_rank", "_prefix", "_before"
    )


def exact_stratified_split(frame: DataFrame, label: str, identifier: str = "incident_id",
                           test: float = 0.2, seed: int = 42) -> DataFrame:
    """Mark the exact share of each class as test rows."""
    quota = F.round(F.col("_size") * test)
    return (
        _places(frame, label, identifier, seed)
        .withColumn("is_test", F.col("_place") <= quota)
        .drop("_place", "_size")
    )


def stratified_folds(frame: DataFrame, label: str, folds: int = 5,
                     identifier: str = "incident_id", seed: int = 42) -> DataFrame:
    """Deal the rows of each class out to the folds in turn."""
    return (
        _places(frame, label, identifier, seed)
        .withColumn("fold", ((F.col("_place") - 1) % folds).cast("int"))
        .drop("_place", "_size")
    )


def class_weights(frame: DataFrame, label: str) -> DataFrame:
    """Weight n / (classes * n_class) per class."""
    counts = frame.groupBy(label).agg(F.count("*").alias("n"))
    whole = Window.partitionBy()
    return counts.withColumn(
        "weight", F.sum("n").over(whole) / (F.count("*").over(whole) * F.col("n"))
    )


def class_balance(frame: DataFrame, label: str) -> DataFrame:
    """Rows, share and the imbalance ratio (other rows per row of the class)."""
    counts = frame.groupBy(label).agg(F.count("*").alias("tickets"))
    total = F.sum("tickets").over(Window.partitionBy())
    return counts.select(
        label, "tickets",
        N.percent(F.col("tickets"), total).alias("pct"),
        ((total - F.col("tickets")) / (F.col("tickets") + 1)).alias("ratio"),
    )


def sigma_flags(frame: DataFrame, column: str, identifier: str, sigmas: float = 3.0) -> DataFrame:
    """Rows far from the mean (classic) and from the median (robust, by MAD)."""
    value = F.col(column)
    median = ordered.as_one_row(
        ordered.quantiles(frame, [column], {"med": 0.5}), [column], ["med"]
    )
    deviations = frame.withColumn("_m", median).select(
        F.abs(value - F.col(f"_m.{column}_med")).alias("dev")
    )
    mad = ordered.as_one_row(
        ordered.quantiles(deviations, ["dev"], {"med": 0.5}), ["dev"], ["med"]
    )
    moments = frame.agg(
        F.struct(F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd"))
    ).scalar()
    placed = frame.withColumn("_s", moments).withColumn("_m", median).withColumn("_d", mad)
    z = (value - F.col("_s.mean")) / F.nullif(F.col("_s.sd"), F.lit(0.0))
    robust = (
        F.lit(0.6745) * (value - F.col(f"_m.{column}_med"))
        / F.nullif(F.col("_d.dev_med"), F.lit(0.0))
    )
    return placed.select(
        identifier, value,
        F.round(z, 6).alias("z"), F.round(robust, 6).alias("robust_z"),
        F.when(F.abs(z) > sigmas, 1).otherwise(0).alias("is_extreme"),
        F.when(F.abs(robust) > sigmas, 1).otherwise(0).alias("is_extreme_robust"),
    )
