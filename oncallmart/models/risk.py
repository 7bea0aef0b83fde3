"""SLA-risk classifier: encoding, boosted trees, explanation, selection, tuning."""

import math
from dataclasses import dataclass, replace
from functools import partial
from itertools import product

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import (
    OneHotEncoder,
    StandardScaler,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oncallmart import schema as S
from oncallmart.models import histogram_trees as trees
from oncallmart.models import paths, wide_trees
from oncallmart.operators import evaluation, prep
from oncallmart.session import settle, side_by_side, use_shared_checkpoints

LABEL = "target_excedeu_tempo"
# Cells (row, feature) of a task: the fits keep a number of every feature for each cached row.
TASK_CELLS = 10_000_000
# Up to so many training rows Spark fits the trees; beyond, `wide_trees` grows the same ones.
SPARK_ROWS = 100_000
GRID = {"maxDepth": [4, 6, 8], "stepSize": [0.05, 0.1, 0.2], "maxIter": [50, 100, 150]}


class Leak(Exception):
    """An outcome column reached the features of a risk model."""


def feature_columns(mart: DataFrame, chosen: list[str] | None = None) -> tuple[list, list]:
    """(numeric, categorical) inputs; naming an outcome column is an error."""
    names = chosen or [c for c in mart.columns if c not in S.RISK_LEAKS]
    leaked = sorted(set(names) & set(S.RISK_LEAKS))
    if leaked:
        raise Leak(f"outcome columns among the features: {leaked}")
    text = [c for c in names if isinstance(mart.schema[c].dataType, T.StringType)]
    return [c for c in names if c not in text], text


@dataclass
class Encoder:
    """Everything learnt from the training rows, applied to any rows.

    Every training level has its own place; the levels stay a table (column, level, place),
    and the driver holds only their number.
    """

    numeric: list[str]
    text: list[str]
    levels: DataFrame
    sizes: dict[str, int]
    model: PipelineModel

    def _placed(self, frame: DataFrame) -> DataFrame:
        placed = frame.na.fill(0, self.numeric)
        for column in self.text:
            known = self.levels.where(F.col("column") == column).select(
                F.col("level").alias("_level"), F.col("place").alias("_place")
            )
            # A level that training did not have takes the place after the last.
            placed = (
                placed.withColumn("_level", F.coalesce(F.col(column), F.lit("unknown")))
                .join(known, "_level", "left")
                .withColumn(f"{column}__i", F.coalesce("_place", F.lit(self.sizes[column])).cast("double"))
                .drop("_level", "_place")
            )
        return placed

    def apply(self, frame: DataFrame) -> DataFrame:
        return self.model.transform(self._placed(frame)).select(
            *[c for c in frame.columns if c not in {*self.numeric, *self.text}], "features"
        )

    def values(self, frame: DataFrame) -> DataFrame:
        """Instead of the vector, `x`: the numbers, then the place of each text's level."""
        places = [F.col(f"{c}__i") for c in self.text]
        numbers = [F.col(c).cast("double") for c in self.numeric]
        return self._placed(frame).select(
            *[c for c in frame.columns if c not in {*self.numeric, *self.text}],
            F.array(*numbers, *places).alias("x"),
        )

    def width(self) -> int:
        return len(self.numeric) + sum(n + 1 for n in self.sizes.values())

    def names(self) -> DataFrame:
        """Feature names by their place in the vector: (pos, feature)."""
        spark = self.levels.sparkSession
        fixed, offsets, at = [(k, c) for k, c in enumerate(self.numeric)], [], len(self.numeric)
        for column in self.text:
            offsets.append(F.when(F.col("column") == column, at))
            at += self.sizes[column]
            fixed.append((at, f"{column}___unseen"))
            at += 1
        named = spark.createDataFrame(fixed, "pos int, feature string")
        if not self.text:
            return named
        return self.levels.select(
            (F.coalesce(*offsets) + F.col("place")).cast("int").alias("pos"),
            F.concat_ws("_", "column", "level").alias("feature"),
        ).union(named)


def fit_encoder(train: DataFrame, columns: list[str] | None = None) -> Encoder:
    """All training levels one-hot encoded, the most frequent first, next to the plain numbers."""
    numeric, text = feature_columns(train, columns)
    levels = settle(prep.numbered_levels(train, text))
    found = {r["column"]: r["n"] for r in levels.groupBy("column").agg(F.count("*").alias("n")).collect()}
    sizes = {c: found.get(c, 0) for c in text}
    stages = []
    if text:
        encoder = OneHotEncoder(
            inputCols=[f"{c}__i" for c in text], outputCols=[f"{c}__h" for c in text], dropLast=False
        )
        # Fitting only looks for the largest place of a column.
        largest = train.sparkSession.createDataFrame(
            [tuple(float(sizes[c]) for c in text)], ", ".join(f"`{c}__i` double" for c in text)
        )
        stages.append(encoder.fit(largest))
    stages.append(
        VectorAssembler(inputCols=[*numeric, *[f"{c}__h" for c in text]], outputCol="features")
    )
    return Encoder(numeric, text, levels, sizes, PipelineModel(stages=stages))


@dataclass
class Prepared:
    train: DataFrame
    test: DataFrame
    encoder: Encoder


def prepare(mart: DataFrame, columns: list[str] | None = None, seed: int = 42) -> Prepared:
    """Stratified split first, then an encoder fitted on the training rows only."""
    labelled = mart.where(F.col(LABEL).isNotNull())
    split = settle(prep.exact_stratified_split(labelled, LABEL, seed=seed))
    train_rows, test_rows = split.where(~F.col("is_test")), split.where("is_test")
    encoder = fit_encoder(train_rows.drop("is_test"), columns)

    def encoded(rows: DataFrame) -> DataFrame:
        made = encoder.apply(rows.drop("is_test"))
        return settle(made.select("incident_id", F.col(LABEL).alias("label"), "features"))

    return Prepared(encoded(train_rows), encoded(test_rows), encoder)


def boosted(trees: int = 100, depth: int = 6, rate: float = 0.1, seed: int = 42,
            weight: str | None = None) -> GBTClassifier:
    made = GBTClassifier(
        featuresCol="features", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=rate,
        seed=seed, checkpointInterval=10,
    )
    return made.setWeightCol(weight) if weight else made


def spread(rows: DataFrame) -> DataFrame:
    """Many rows in parts of bounded size. Stored vectors are small, so a part of a file can
    hold far more rows than a task can keep once every feature has its number."""
    first = rows.select("features").first()
    parts = math.ceil(rows.count() * first["features"].size / TASK_CELLS) if first else 0
    return rows.repartition(parts) if parts > rows.sparkSession.sparkContext.defaultParallelism else rows


def fit(train: DataFrame, trees: int = 100, depth: int = 6, rate: float = 0.1, seed: int = 42,
        weight: str | None = None):
    use_shared_checkpoints(train.sparkSession)
    if weight is None and train.count() > SPARK_ROWS:
        return wide_trees.fit(train.withColumn("fold", F.lit(0)), trees, depth, rate)[0]
    return boosted(trees, depth, rate, seed, weight).fit(spread(train))


def fit_folds(folded: DataFrame, folds: int, trees: int = 100, depth: int = 6, rate: float = 0.1, seed: int = 42) -> list:
    """A model for each fold, from the rows of the others; many rows are passed over once for all."""
    use_shared_checkpoints(folded.sparkSession)
    if folded.count() > SPARK_ROWS:
        return wide_trees.fit(folded, trees, depth, rate, list(range(folds)))
    rest = [folded.where(F.col("fold") != fold) for fold in range(folds)]
    return side_by_side(
        folded.sparkSession, [partial(fit, rows, trees, depth, rate, seed) for rows in rest], folds
    )


def with_class_weights(train: DataFrame) -> DataFrame:
    """Weight column that makes both classes count the same."""
    weights = prep.class_weights(train, "label").select("label", "weight")
    return train.join(F.broadcast(weights), "label")


def score(model, frame: DataFrame) -> DataFrame:
    """incident_id, y_real, y_pred, y_pred_proba."""
    return model.transform(frame).select(
        "incident_id",
        F.col("label").cast("int").alias("y_real"),
        F.col("prediction").cast("int").alias("y_pred"),
        vector_to_array("probability")[1].alias("y_pred_proba"),
    )


def alerts(scores: DataFrame, above: float = 0.8) -> DataFrame:
    return scores.where(F.col("y_pred_proba") > above)


def auc_of(scores: DataFrame) -> float:
    return evaluation.auc(scores, "y_real", "y_pred_proba").first()["auc"]


# --- Explanation ---------------------------------------------------------------------


def linear_shap(prepared: Prepared) -> DataFrame:
    """Mean absolute exact SHAP value per feature of a logistic model.

    For a linear model the SHAP value of a feature is its weight times its
    distance from the training mean.
    """
    train = spread(prepared.train)
    scaler = StandardScaler(
        inputCol="features", outputCol="scaled", withMean=True, withStd=True
    ).fit(train)
    model = LogisticRegression(
        featuresCol="scaled", labelCol="label", regParam=1e-4, maxIter=100
    ).fit(scaler.transform(train))
    # The sum of absolute values of every dimension, from one vector aggregate.
    sizes = scaler.transform(prepared.test).select(
        Summarizer.metrics("normL1", "count").summary(F.col("scaled")).alias("s")
    ).select("s.*").first()
    effects = abs(model.coefficients.toArray()) * sizes["normL1"].toArray() / sizes["count"]
    sized = prepared.train.sparkSession.createDataFrame(
        [(k, float(e)) for k, e in enumerate(effects)], "pos int, importance double"
    )
    return sized.join(prepared.encoder.names(), "pos").select("feature", "importance")


def tree_contributions(model, frame: DataFrame) -> DataFrame:
    """(incident_id, base, contributions, margin): what each used feature adds to a ticket's
    margin, next to the margin that the model itself gives."""
    found = paths.of_model(model, frame.sparkSession)
    margins = model.transform(frame).select("incident_id", vector_to_array("rawPrediction")[1].alias("margin"))
    return paths.contributions(found, frame).join(margins, "incident_id")


def tree_importance(model, frame: DataFrame, names: DataFrame) -> DataFrame:
    """Mean absolute Shapley contribution of each feature to the margin."""
    return paths.mean_absolute(paths.of_model(model, frame.sparkSession), frame, names)


def permutation_importance(model, frame: DataFrame, names: DataFrame) -> DataFrame:
    """Mean absolute change of the predicted probability when one feature is swapped.

    Each row takes the feature from another row: rows are put into buckets by a
    hash of their id, and inside a bucket each borrows from the next in hash
    order. That is one shuffle for all features, with buckets of even size
    whatever the data looks like. A row and its donor travel once, as the features that the
    trees use; all swaps are scored in the task.
    """
    found = paths.of_model(model, frame.sparkSession)
    rows = frame.count()
    buckets = max(1, rows // 1000)
    order = F.xxhash64("incident_id", F.lit(7))
    ring = Window.partitionBy("bucket").orderBy("order", "incident_id")
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    paired = (
        paths.sliced(found, frame.select("incident_id", "features"))
        .select("incident_id", "x", order.alias("order"))
        .withColumn("bucket", F.pmod(F.xxhash64("incident_id", F.lit(11)), F.lit(buckets)))
        .withColumn("donor", F.coalesce(F.lead("x").over(ring), F.first("x").over(whole)))
    )
    return names.join(paths.swap_changes(found, paired), "pos", "left").select(
        "feature", (F.coalesce("s", F.lit(0.0)) / F.lit(float(max(rows, 1)))).alias("importance")
    )


# --- Selection and tuning --------------------------------------------------------------


def select_features(prepared: Prepared, ranking: DataFrame, above: float = 0.005) -> Prepared:
    """Keep the features whose importance exceeds the threshold."""
    kept = ranking.where(F.col("importance") > above).join(prepared.encoder.names(), "feature")
    places = sorted(r["pos"] for r in kept.select("pos").collect())
    if not places:
        raise ValueError(f"no feature has an importance above {above}")
    slicer = VectorSlicer(inputCol="features", outputCol="kept", indices=places)

    def cut(frame: DataFrame) -> DataFrame:
        return slicer.transform(frame).select(
            "incident_id", "label", F.col("kept").alias("features")
        )

    return Prepared(cut(prepared.train), cut(prepared.test), prepared.encoder)


def metric_rows(spark, values: dict[str, float]) -> DataFrame:
    return spark.createDataFrame(
        [(k, float(v)) for k, v in values.items()], "metric string, value double"
    )


def selection_report(prepared: Prepared, above: float = 0.005, **parameters) -> DataFrame:
    """Areas under the curve before and after dropping weak features."""
    full = fit(prepared.train, **parameters)
    names = prepared.encoder.names()
    ranking = settle(permutation_importance(full, prepared.test, names))
    reduced = select_features(prepared, ranking, above)
    kept = ranking.where(F.col("importance") > above).count()
    before = auc_of(score(full, prepared.test))
    after = auc_of(score(fit(reduced.train, **parameters), reduced.test))
    return metric_rows(
        prepared.train.sparkSession,
        {
            "auc_roc_baseline": before, "auc_roc_selected": after, "auc_loss": before - after,
            "n_features": prepared.encoder.width(), "n_features_selected": kept,
            "pct_feature_reduction": 100 * (1 - kept / prepared.encoder.width()),
        },
    )


def grid_search(prepared: Prepared, grid: dict[str, list] = GRID, seed: int = 42) -> DataFrame:
    """One row per combination with its area under the curve and F1."""
    def evaluate(depth: int, rate: float, trees: int) -> tuple:
        model = fit(prepared.train, trees=trees, depth=depth, rate=rate, seed=seed)
        scores = settle(score(model, prepared.test))
        f1 = evaluation.confusion(scores, "y_real", "y_pred").first()["f1"]
        return depth, rate, trees, auc_of(scores), f1

    combinations = product(grid["maxDepth"], grid["stepSize"], grid["maxIter"])
    spark = prepared.train.sparkSession
    found = side_by_side(spark, [partial(evaluate, *c) for c in combinations])
    return spark.createDataFrame(
        found, "max_depth int, learning_rate double, n_estimators int, auc_roc double, f1 double"
    )


@dataclass
class Binned:
    """Rows of (incident_id, label, fold, codes) for models grown together."""

    train: DataFrame
    test: DataFrame
    columns: trees.Columns
    encoder: Encoder

    def names(self) -> dict:
        """Names of the columns, and of the (column, level) pairs of texts."""
        numbers, n = dict(enumerate(self.encoder.numeric)), len(self.encoder.numeric)
        at = {c: n + k for k, c in enumerate(self.encoder.text)}
        levels = {
            (at[r["column"]], r["place"]): f"{r['column']}_{r['level']}" for r in self.encoder.levels.collect()
        }
        unseen = {(at[c], self.encoder.sizes[c]): f"{c}___unseen" for c in self.encoder.text}
        return {**numbers, **levels, **unseen}


def prepare_binned(mart: DataFrame, columns: list[str] | None = None, folds: int = 5, seed: int = 42) -> Binned:
    """The split of `prepare` with bins fitted on the training rows, which also have a fold."""
    labelled = mart.where(F.col(LABEL).isNotNull())
    split = settle(prep.exact_stratified_split(labelled, LABEL, seed=seed))
    train_rows, test_rows = split.where(~F.col("is_test")), split.where("is_test")
    encoder = fit_encoder(train_rows.drop("is_test"), columns)

    def valued(rows: DataFrame) -> DataFrame:
        return encoder.values(rows.drop("is_test")).select(
            "incident_id", F.col(LABEL).cast("double").alias("label"), "x"
        )

    train = settle(prep.stratified_folds(valued(train_rows), "label", folds, seed=seed))
    first = len(encoder.numeric)
    sizes = {first + k: encoder.sizes[c] + 1 for k, c in enumerate(encoder.text)}
    bins = trees.bins_of(train, sizes, first + len(encoder.text))

    def binned(rows: DataFrame) -> DataFrame:
        return settle(trees.coded(rows, bins, ["incident_id", "label", "fold"]))

    return Binned(binned(train), binned(valued(test_rows).withColumn("fold", F.lit(-1))), bins, encoder)


def _quality(scored: DataFrame, by: str) -> DataFrame:
    """Area under the curve and F1 of (label, score) by model."""
    scored = settle(scored)
    areas = evaluation.auc(scored, "label", "score", [by]).select(by, F.col("auc").alias("auc_roc"))
    hit, said = F.col("label") == 1, F.col("score") > 0.5
    f1 = scored.groupBy(by).agg(
        (2 * F.count_if(hit & said) / F.nullif(F.count_if(hit) + F.count_if(said), F.lit(0))).alias("f1")
    )
    return areas.join(f1.select(by, F.coalesce("f1", F.lit(0.0)).alias("f1")), by)


def joint_grid_search(ready: Binned, grid: dict[str, list] = GRID, local_rows: int | None = None) -> DataFrame:
    """One row per combination with its area under the curve and F1 on the test rows. All
    combinations grow together, those that differ in the number of trees as one."""
    plans = [trees.Plan(*c) for c in product(grid["maxDepth"], grid["stepSize"], grid["maxIter"])]
    models = trees.fit(ready.train, plans, ready.columns, local_rows)
    scored = trees.scores(ready.test, plans, models, ready.columns).select("label", F.posexplode("p").alias("model", "score"))
    told = ready.train.sparkSession.createDataFrame(
        [(k, p.depth, p.rate, p.trees) for k, p in enumerate(plans)],
        "model int, max_depth int, learning_rate double, n_estimators int",
    )
    return told.join(_quality(scored, "model"), "model").drop("model")


def cross_validate_selected(ready: Binned, plan: trees.Plan = trees.Plan(), above: float = 0.005, folds: int = 5,
                            local_rows: int | None = None) -> tuple[DataFrame, dict[int, dict]]:
    """Each fold ranks, selects and fits without its own rows: (fold, tickets, n_features,
    n_selected, auc_roc_all, auc_roc), and the selected features with their share of the gain
    by fold. A feature is kept if the trees owe it more than `above` of their gain."""
    first = [replace(plan, left_out=k) for k in range(folds)]
    full = trees.fit(ready.train, first, ready.columns, local_rows)
    kept = [{f: g for f, g in trees.gains(model, ready.columns).items() if g > above} for model in full]
    second = [replace(p, allowed=frozenset(k)) for p, k in zip(first, kept, strict=True)]
    reduced = trees.fit(ready.train, second, ready.columns, local_rows)
    scored = settle(
        trees.scores(ready.train, [*first, *second], [*full, *reduced], ready.columns, unseen=True).select(
            "label", "fold", F.get("p", F.col("fold")).alias("all"), F.get("p", F.col("fold") + folds).alias("some")
        )
    )
    areas = [
        evaluation.auc(scored, "label", c, ["fold"]).select(
            "fold", (F.col("positives") + F.col("negatives")).alias("tickets"), F.col("auc").alias(name)
        )
        for c, name in (("all", "auc_roc_all"), ("some", "auc_roc"))
    ]
    told = ready.train.sparkSession.createDataFrame(
        [(k, ready.encoder.width(), len(kept[k])) for k in range(folds)], "fold int, n_features int, n_selected int"
    )
    return areas[0].join(areas[1].drop("tickets"), "fold").join(told, "fold"), dict(enumerate(kept))


def best_of_grid(results: DataFrame) -> DataFrame:
    order = F.struct("auc_roc", -F.col("max_depth"), -F.col("n_estimators"))
    return results.agg(F.max_by(F.struct(*results.columns), order).alias("b")).select("b.*")


def cross_validate(train: DataFrame, folds: int = 5, seed: int = 42, **parameters) -> DataFrame:
    """Area under the curve of each stratified fold: fold, rows, auc."""
    folded = settle(prep.stratified_folds(train, "label", folds, seed=seed))

    models = fit_folds(folded, folds, seed=seed, **parameters)

    def evaluate(fold: int) -> tuple:
        result = evaluation.auc(
            score(models[fold], folded.where(F.col("fold") == fold)), "y_real", "y_pred_proba"
        ).first()
        return fold, result["positives"] + result["negatives"], result["auc"]

    found = side_by_side(
        train.sparkSession, [partial(evaluate, fold) for fold in range(folds)], folds
    )
    return train.sparkSession.createDataFrame(found, "fold int, tickets bigint, auc double")


def selected(prepared: Prepared, above: float = 0.005, **parameters) -> Prepared:
    """The prepared rows with the features that matter to the fitted trees."""
    model = fit(prepared.train, **parameters)
    ranking = settle(permutation_importance(model, prepared.test, prepared.encoder.names()))
    return select_features(prepared, ranking, above)


def cv_summary(scores: DataFrame) -> DataFrame:
    return scores.agg(
        F.avg("auc").alias("cv_auc_mean"), F.stddev_pop("auc").alias("cv_auc_std")
    )
