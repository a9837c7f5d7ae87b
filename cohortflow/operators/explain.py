"""Additive explanations of scores.

Contributions travel as one array column per row - struct(feature, value, phi) in
feature order - next to ``base``, the expected margin. Ranking, running totals and
texts then are array expressions that need no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow import defaults
from cohortflow.functions import coalitions
from cohortflow.functions.scalars import nan_as_missing, risk_band
from cohortflow.functions.trees import Forest
from cohortflow.operators.train import row_hash

CONTRIBUTIONS = "array<struct<feature: string, value: double, phi: double>>"


def linear_shap(df: DataFrame, weights: Mapping[str, float], intercept: float = 0.0) -> DataFrame:
    """Contributions weight * (value - mean) of a linear score; means over the whole table.

    A missing value contributes nothing, as if it were the mean.
    """
    df = nan_as_missing(df)
    means = df.agg(
        F.struct(*[F.avg(F.col(f).cast("double")).alias(f) for f in weights])
    ).scalar()
    base = F.lit(float(intercept))
    parts = []
    for feature, weight in weights.items():
        value = F.col(feature).cast("double")
        phi = F.coalesce(F.lit(float(weight)) * (value - means[feature]), F.lit(0.0))
        base = base + F.lit(float(weight)) * means[feature]
        parts.append(
            F.struct(F.lit(feature).alias("feature"), value.alias("value"), phi.alias("phi"))
        )
    return df.select("*", base.alias("base"), F.array(*parts).alias("contributions"))


def _with_phi(df: DataFrame, features: Sequence[str], phi: str = "_phi") -> DataFrame:
    parts = [
        F.struct(
            F.lit(f).alias("feature"),
            F.col(f).cast("double").alias("value"),
            F.col(phi)[i].alias("phi"),
        )
        for i, f in enumerate(features)
    ]
    return df.withColumn("contributions", F.array(*parts)).drop(phi, "inputs")


def _map_inputs(
    df: DataFrame, phi_of: Callable[[np.ndarray], np.ndarray], base: float
) -> DataFrame:
    """Applies a vectorised function of the ``inputs`` array, batch by batch."""
    schema = T.StructType(
        [*df.schema.fields, *T.StructType.fromDDL("base double, _phi array<double>").fields]
    )

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                phi = phi_of(np.stack(batch["inputs"].to_numpy()))
                yield batch.assign(base=base, _phi=list(phi))

    return df.mapInPandas(explain, schema)


def tree_shap(assembled: DataFrame, forest: Forest, features: Sequence[str]) -> DataFrame:
    """Path-dependent contributions to the margin of a tree ensemble.

    ``assembled`` comes from ``train.assembled``. A feature and its missing flag
    count as one. A row costs leaves x depth^2 steps, whatever the depth. The trees go
    to the tasks with the function; their size is that of the model, not of the data.
    Executors need this package (``session.ship_package``).
    """
    width = len(features)

    def phi_of(inputs: np.ndarray) -> np.ndarray:
        phi = forest.contributions(inputs)
        return phi[:, :width] + phi[:, width:]

    return _with_phi(_map_inputs(assembled, phi_of, forest.base), features)


def background_sample(
    assembled: DataFrame, keys: Sequence[str], n: int = defaults.BACKGROUND_ROWS
) -> np.ndarray:
    """Model inputs of the n rows of smallest key hash; a bounded sample by design, which goes to
    every task."""
    rows = assembled.orderBy(row_hash(keys), *keys).select("inputs").limit(n).collect()
    return np.array([row["inputs"] for row in rows])


def kernel_shap(
    assembled: DataFrame,
    predict: Callable[[np.ndarray], np.ndarray],
    background: np.ndarray,
    features: Sequence[str],
    partitions: int | None = None,
    sets: int = coalitions.SETS,
    seed: int = defaults.SEED,
) -> DataFrame:
    """Model-agnostic contributions to ``predict`` (a function of a matrix of inputs): absent features take the
    values of each background row in turn, and a weighted fit over sets of known features gives the Shapley
    values, exactly if all sets (2^features - 2) are no more than ``sets``, else from sets drawn in pairs.

    The sets are drawn once and shared by all rows; a batch of rows costs one solve and rows x sets x background
    predictions, so few bytes keep a core busy for long; ``partitions`` spreads the rows wider than their
    size would. ``Forest.probability`` makes the predictions of a set together, from its leaves; any other function
    is called with every mix. Any number of background rows is taken; they go to every task. An empty table gives an empty one.
    """
    if partitions:
        assembled = assembled.repartition(partitions)
    if not len(background):
        raise ValueError("contributions need background rows")
    shared = coalitions.Coalitions.of(len(features), sets, seed)

    def phi_of(inputs: np.ndarray) -> np.ndarray:
        return coalitions.contributions(predict, inputs, background, shared)

    base = float(np.mean(predict(background)))
    return _with_phi(_map_inputs(assembled, phi_of, base), features)


def total(contributions: Column, base: Column) -> Column:
    return F.aggregate(contributions, base, lambda acc, c: acc + c["phi"])


def shap_additivity(
    explained: DataFrame,
    margin: str = "margin",
    tolerance: float = defaults.ADDITIVITY_TOLERANCE,
) -> DataFrame:
    """(n, max_error, passed): base plus contributions against the margin."""
    error = F.abs(F.col(margin) - total(F.col("contributions"), F.col("base")))
    return explained.agg(
        F.count("*").alias("n"),
        F.max(error).alias("max_error"),
        (F.max(error) <= tolerance).alias("passed"),
    )


def shap_global(
    explained: DataFrame, features: Sequence[str], top_k: int | None = None
) -> DataFrame:
    """(feature, importance): mean absolute contribution, largest first."""
    means = explained.agg(
        *[F.avg(F.abs(F.col("contributions")[i]["phi"])).alias(f) for i, f in enumerate(features)]
    )
    rows = [F.struct(F.lit(f).alias("feature"), F.col(f).alias("importance")) for f in features]
    ranked = means.select(F.inline(F.array(*rows))).orderBy(F.desc("importance"), "feature")
    return ranked.limit(top_k) if top_k else ranked


def by_magnitude(contributions: Column, ascending: bool = False) -> Column:
    """The array ordered by absolute contribution, then feature name."""
    sign = F.lit(1.0 if ascending else -1.0)
    keyed = F.transform(
        contributions,
        lambda c: F.struct(
            (sign * F.abs(c["phi"])).alias("k"),
            c["feature"].alias("feature"),
            c["value"].alias("value"),
            c["phi"].alias("phi"),
        ),
    )
    return F.transform(
        F.sort_array(keyed),
        lambda c: F.struct(
            c["feature"].alias("feature"), c["value"].alias("value"), c["phi"].alias("phi")
        ),
    )


def shap_local_top(explained: DataFrame, ids: Sequence[str], k: int = 5) -> DataFrame:
    """(*ids, rank, feature, value, phi): the k largest contributions of every row."""
    top = F.slice(by_magnitude(F.col("contributions")), 1, k)
    return explained.select(*ids, F.posexplode(top).alias("pos", "c")).select(
        *ids, (F.col("pos") + 1).alias("rank"), "c.feature", "c.value", "c.phi"
    )


def waterfall_steps(explained: DataFrame, ids: Sequence[str]) -> DataFrame:
    """(*ids, step, feature, phi, start, stop): running total from the base upwards,
    smallest contributions first."""
    base = F.col("base")

    def extend(done: Column, c: Column) -> Column:
        start = F.coalesce(F.try_element_at(done, F.lit(-1))["stop"], base)
        step = F.struct(
            (F.size(done) + 1).alias("step"),
            c["feature"].alias("feature"),
            c["phi"].alias("phi"),
            start.alias("start"),
            (start + c["phi"]).alias("stop"),
        )
        return F.concat(done, F.array(step))

    none = F.array().cast(
        "array<struct<step: int, feature: string, phi: double, start: double, stop: double>>"
    )
    ordered = by_magnitude(F.col("contributions"), ascending=True)
    return explained.select(*ids, F.inline(F.aggregate(ordered, none, extend)))


def explanation_text(
    probability: Column, base: Column, contributions: Column, subject: Column, generated: Column
) -> Column:
    """A report on one prediction: summary, the five strongest features, how to read them."""
    blocks = F.transform(
        F.slice(by_magnitude(contributions), 1, 5),
        lambda c, i: F.format_string(
            defaults.EXPLANATION_FEATURE,
            i + 1,
            c["feature"],
            F.when(c["value"].isNull(), "missing").otherwise(F.format_string("%.2f", c["value"])),
            c["phi"],
            F.when(c["phi"] > 0, "increases").otherwise("decreases"),
        ),
    )
    head = F.format_string(
        defaults.EXPLANATION_HEAD,
        subject.cast("string"),
        F.date_format(generated, "yyyy-MM-dd HH:mm:ss"),
        probability,
        F.initcap(risk_band(probability, strict=True)),
        base,
    )
    tail = F.lit(defaults.EXPLANATION_TAIL)
    return F.concat_ws("\n", head, F.concat_ws("\n", blocks), tail)


def high_risk_explanations(
    explained: DataFrame,
    subject: str,
    generated: Column,
    threshold: float = 0.5,
    score: str = "prediction_proba",
) -> DataFrame:
    """Rows scored at or above the threshold with their top features and report text."""
    return explained.where(F.col(score) >= threshold).select(
        "*",
        F.slice(by_magnitude(F.col("contributions")), 1, 5).alias("top_features"),
        explanation_text(
            F.col(score), F.col("base"), F.col("contributions"), F.col(subject), generated
        ).alias("report"),
    )
