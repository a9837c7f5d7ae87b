"""Split, class weights, boosted trees and scoring."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortflow import defaults
from cohortflow.functions.scalars import nan_as_missing
from cohortflow.operators import evaluate
from cohortflow.operators.calibrate import apply_isotonic
from cohortflow.operators.merge import require_columns
from cohortflow.sources.scratch import discard, settle

# Hash prefixes grow by this many hex digits: 4,096 buckets per class and step.
PREFIX_DIGITS, HASH_DIGITS = 3, 33
# So few rows under a class's prefix are ranked.
RANKED_ROWS = 100_000


def feature_columns(
    df: DataFrame,
    target: str = defaults.TARGET,
    id_columns: Sequence[str] = defaults.ID_COLUMNS,
) -> list[str]:
    """All columns but the ids, the target and earlier predictions."""
    require_columns(df, [target], "dataset")
    excluded = {target, *id_columns, *defaults.NOT_FEATURES}
    return [c for c in df.columns if c not in excluded]


def row_hash(keys: Sequence[str], seed: int = defaults.SEED) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def stratified_split(
    df: DataFrame,
    keys: Sequence[str],
    target: str = defaults.TARGET,
    share: float = defaults.VALIDATION_SHARE,
    seed: int = defaults.SEED,
    stratify: bool = True,
) -> DataFrame:
    """Adds ``is_validation``: in each class the ceil(share * n) rows of smallest key hash.

    The cut-off hash of a class is found digit by digit: counts of the next PREFIX_DIGITS digits locate the
    quota's prefix, and only rows under that prefix are counted by their next digits, until so few are
    left that they can be ranked. Nothing else is shuffled, and two rows carry the cut-offs to the table.
    Copies of a key share its hash and so stay on one side. ``df`` is read a few times; store it first if it
    is costly to compute.
    """
    group = F.col(target).cast("int") if stratify else F.lit(0)
    hashed = df.withColumn("_class", group).withColumn("_hash", row_hash(keys, seed))
    cutoffs = _cutoffs(hashed.select("_class", "_hash"), share)
    return (
        hashed.join(F.broadcast(cutoffs), "_class", "left")
        .withColumn("is_validation", F.coalesce(F.col("_hash") <= F.col("_cutoff"), F.lit(False)))
        .drop("_class", "_hash", "_cutoff")
    )


def _cutoffs(hashed: DataFrame, share: float) -> DataFrame:
    """(_class, _cutoff): the hash of the last row of each class's quota."""
    quota = F.ceil(F.lit(float(share)) * F.count("*")).alias("_take")
    edge = hashed.groupBy("_class").agg(F.lit("").alias("_prefix"), F.count("*").alias("_n"), quota)
    edge = settle(edge.where("_take > 0 and _class is not null"), "edges")  # a row per class
    length = 0
    while length < HASH_DIGITS and (edge.agg(F.max("_n")).first()[0] or 0) > RANKED_ROWS:
        under = hashed.withColumn("_prefix", F.substring("_hash", 1, length))
        under = under.join(F.broadcast(edge.select("_class", "_prefix", "_take")), ["_class", "_prefix"])
        length += PREFIX_DIGITS
        # At most 16^PREFIX_DIGITS rows per class; one of them per class survives.
        upto = Window.partitionBy("_class").orderBy("_prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        counts = under.groupBy("_class", "_take", F.substring("_hash", 1, length).alias("_prefix")).agg(F.count("*").alias("_n"))
        counts = counts.withColumn("_upto", F.sum("_n").over(upto))
        before = F.col("_upto") - F.col("_n")
        found = counts.where((before < F.col("_take")) & (F.col("_take") <= F.col("_upto")))
        edge = settle(found.select("_class", "_prefix", "_n", (F.col("_take") - before).alias("_take")), "edges")
    ranked = Window.partitionBy("_class").orderBy("_hash")  # RANKED_ROWS per class, or copies of one hash
    rows = hashed.withColumn("_prefix", F.substring("_hash", 1, length)).join(F.broadcast(edge), ["_class", "_prefix"])
    if length >= HASH_DIGITS:
        return edge.select("_class", F.col("_prefix").alias("_cutoff"))
    rows = rows.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") == F.col("_take"))
    return rows.select("_class", F.col("_hash").alias("_cutoff"))


def split_by_time(df: DataFrame, cutoff: Column, as_of: str = "as_of") -> DataFrame:
    """Adds ``is_validation``: index dates from the cut-off on."""
    return df.withColumn("is_validation", F.col(as_of) >= cutoff)


def fold_bounds(df: DataFrame, folds: int, as_of: str = "as_of") -> DataFrame:
    """(fold, valid_from, valid_until, n_train, n_valid) of a rolling origin: the span of index dates is cut into
    folds + 1 equal parts; fold k validates on part k + 1 and trains on all before it. Parts are closed below, the
    last one on both sides. Rows without a date are in no fold; a table of one date has empty folds."""
    kind = df.schema[as_of].dataType
    micros = F.unix_micros(F.col(as_of).cast("timestamp"))
    span = df.agg(F.min(micros).alias("low"), F.max(micros).alias("high"))
    part = F.greatest(F.ceil((F.col("high") - F.col("low") + 1) / (folds + 1)), F.lit(1))
    # Rows per part, a map of folds + 1 entries.
    low, width = span.select("low").scalar(), span.select(part.cast("bigint")).scalar()
    place = F.floor((micros - low) / width).cast("int")
    counts = df.where(F.col(as_of).isNotNull()).groupBy(place.alias("_part")).agg(F.count("*").alias("_n"))
    bounds = counts.agg(F.map_from_entries(F.collect_list(F.struct("_part", "_n"))).alias("_rows")).select(
        F.explode(F.sequence(F.lit(1), F.lit(folds))).alias("fold"), "_rows", low.alias("low"), width.alias("part")
    ).where("low is not null")

    def rows_in(number: Column) -> Column:
        return F.coalesce(F.try_element_at(F.col("_rows"), number), F.lit(0))

    before = F.aggregate(F.sequence(F.lit(0), F.col("fold") - 1), F.lit(0).cast("bigint"), lambda n, i: n + rows_in(i))
    sizes = bounds.select(
        "fold",
        (F.col("low") + F.col("fold") * F.col("part")).alias("_from"),
        (F.col("low") + (F.col("fold") + 1) * F.col("part")).alias("_until"),
        before.alias("n_train"),
        rows_in(F.col("fold")).alias("n_valid"),
    )
    return sizes.select(
        "fold",
        F.timestamp_micros("_from").cast(kind).alias("valid_from"),
        F.timestamp_micros("_until").cast(kind).alias("valid_until"),
        "n_train",
        "n_valid",
    )


def cross_validate(
    df: DataFrame,
    features: Sequence[str],
    folds: int = 3,
    target: str = defaults.TARGET,
    as_of: str = "as_of",
    seed: int = defaults.SEED,
    at_once: int = 2,
    **params,
) -> DataFrame:
    """(fold, valid_from, valid_until, n_train, n_valid, n_trees, auroc, average_precision, brier) of
    rolling-origin folds. Every fit stops early on the fold's validation rows. Fits read one
    stored table and run ``at_once`` at a time; folds whose training rows have a single class, and
    those without validation rows, have no scores.
    """
    spark = df.sparkSession
    rows = settle(df.where(F.col(target).isNotNull()), "folds")
    bounds = sorted(fold_bounds(rows, folds, as_of).collect())

    def fitted(fold) -> dict:
        found = {**fold.asDict(), "n_trees": None, "auroc": None, "average_precision": None, "brier": None}
        until, start = F.lit(fold["valid_until"]), F.lit(fold["valid_from"])
        part = rows.where(F.col(as_of) < until).withColumn("is_validation", F.col(as_of) >= start)
        classes = part.where("not is_validation").select(target).distinct().limit(2).count()
        if classes < 2 or not fold["n_valid"]:
            return found
        model = fit_classifier(part, features, target, seed, **{"validationIndicatorCol": "is_validation", **params})
        scored = settle(score(model, part.where("is_validation"), features), "scored")
        ranks = evaluate.score_ranks(scored, ["prediction_proba"], target)
        found["n_trees"] = model.stages[-1].getNumTrees
        found["auroc"] = evaluate.auroc_from_ranks(ranks).first()["auroc"]
        found["average_precision"] = evaluate.average_precision_from_ranks(ranks).first()["average_precision"]
        found["brier"] = evaluate.brier(scored, ["prediction_proba"], target).first()["brier"]
        discard(scored)
        return found

    with ThreadPoolExecutor(at_once) as pool:
        results = list(pool.map(inheritable_thread_target(spark)(fitted), bounds))
    kind = rows.schema[as_of].dataType.simpleString()
    return spark.createDataFrame(
        [tuple(r.values()) for r in results],
        f"fold int, valid_from {kind}, valid_until {kind}, n_train bigint, n_valid bigint, n_trees int, "
        "auroc double, average_precision double, brier double",
    )


def class_weights(df: DataFrame, target: str = defaults.TARGET) -> DataFrame:
    """(label, n, weight): n_rows / (n_classes * n), the balanced weighting."""
    counts = df.groupBy(F.col(target).cast("int").alias("label")).agg(F.count("*").alias("n"))
    totals = counts.agg(
        F.struct(F.sum("n").alias("rows"), F.count("*").alias("classes"))
    ).scalar()
    return counts.select(
        "label", "n", (totals["rows"].cast("double") / (totals["classes"] * F.col("n"))).alias("weight")
    )


def with_missing_flags(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Features as doubles, each followed by a 0/1 column that marks it missing."""
    df = nan_as_missing(df)
    return df.select(
        *[c for c in df.columns if c not in features],
        *[F.col(c).cast("double").alias(c) for c in features],
        *[F.col(c).isNull().cast("double").alias(f"{c}_missing") for c in features],
    )


def fit_classifier(
    train: DataFrame,
    features: Sequence[str],
    target: str = defaults.TARGET,
    seed: int = defaults.SEED,
    **params,
) -> PipelineModel:
    """Median imputation, missing flags and gradient-boosted trees with balanced weights.

    Pass ``validationIndicatorCol`` to stop early on the rows it marks.
    """
    weights = class_weights(train, target).select(F.col("label").alias("_label"), "weight")
    rows = with_missing_flags(train.where(F.col(target).isNotNull()), features)
    rows = rows.join(
        F.broadcast(weights), rows[target].cast("int") == F.col("_label")
    ).withColumn("_label", F.col("_label").cast("double"))
    imputed = [f"{c}_imputed" for c in features]
    stages = [
        Imputer(strategy="median", inputCols=list(features), outputCols=imputed),
        VectorAssembler(
            inputCols=[*imputed, *[f"{c}_missing" for c in features]], outputCol="features"
        ),
        GBTClassifier(
            featuresCol="features",
            labelCol="_label",
            weightCol="weight",
            seed=seed,
            **{**defaults.GBT, **params},
        ),
    ]
    return Pipeline(stages=stages).fit(rows)


def vector_names(features: Sequence[str]) -> list[str]:
    """Names of the assembled vector's entries."""
    return [*features, *[f"{c}_missing" for c in features]]


def score(model: PipelineModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """The input rows, ids included, with ``prediction_proba`` and ``prediction``."""
    scored = model.transform(with_missing_flags(df, features))
    return scored.select(
        *df.columns,
        vector_to_array("probability")[1].alias("prediction_proba"),
        F.col("prediction").cast("int").alias("prediction"),
    )


def assembled(model: PipelineModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """The input rows with ``prediction_proba``, the margin and the model's inputs as an array."""
    scored = model.transform(with_missing_flags(df, features))
    return scored.select(
        *df.columns,
        vector_to_array("features").alias("inputs"),
        vector_to_array("probability")[1].alias("prediction_proba"),
        vector_to_array("rawPrediction")[1].alias("margin"),
    )


def score_calibrated(
    model: PipelineModel, calibrator, df: DataFrame, features: Sequence[str]
) -> DataFrame:
    return apply_isotonic(calibrator, score(model, df, features))


def feature_importance(
    model: PipelineModel, features: Sequence[str], spark, top: int | None = 10
) -> DataFrame:
    """(feature, importance), largest first; a feature's missing flag counts towards it."""
    values = model.stages[-1].featureImportances.toArray().tolist()
    width = len(features)
    rows = [(name, values[i] + values[i + width]) for i, name in enumerate(features)]
    ranked = spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )
    return ranked.limit(top) if top else ranked
