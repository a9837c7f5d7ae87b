"""Explanations of a linear score, and the fitted classifier on mapping B."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortflow import defaults
from cohortflow.functions.trees import load_forest
from cohortflow.operators import calibrate, explain, train
from cohortflow.operators.windows import dealt
from cohortflow.sources import models, scratch
from workload import panel
from workload.base import query, r6, table, ts

# A linear score over events. "item" is the feature with gaps.

WEIGHTS = {
    "value": -0.0123456789123457,
    "k": 0.0198761234598761,
    "hour": 0.0317171698317171,
    "item": -0.0271828182845905,
}
INTERCEPT = 0.3
IDS = ["event_id"]


def linear(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("event_id")
    rows = table(spark, d, "events").select(
        "event_id",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.hour("ts").alias("hour"),
        F.when(key % 13 != 0, key % 40).alias("item"),
    )
    explained = explain.linear_shap(rows, WEIGHTS, INTERCEPT)
    margin = explain.total(F.col("contributions"), F.col("base"))
    return explained.withColumn("prediction_proba", F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)))


def _phi_sql() -> str:
    means = ", ".join(f"avg({f}) AS {f}" for f in WEIGHTS)
    base = " + ".join(f"{w!r}::DOUBLE * m.{f}" for f, w in WEIGHTS.items())
    phis = ", ".join(
        f"coalesce({w!r}::DOUBLE * (r.{f} - m.{f}), 0) AS phi_{f}" for f, w in WEIGHTS.items()
    )
    total = " + ".join(f"phi_{f}" for f in WEIGHTS)
    return f"""
rows AS (SELECT event_id, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
    hour(ts) AS hour, CASE WHEN event_id % 13 <> 0 THEN event_id % 40 END AS item FROM events),
wide AS (SELECT r.*, {INTERCEPT}::DOUBLE + {base} AS base, {phis}
    FROM rows r, (SELECT {means} FROM rows) m),
scored AS (SELECT *, 1 / (1 + exp(-(base + {total}))) AS score FROM wide),
long AS ({" UNION ALL ".join(
    f"SELECT {', '.join(IDS)}, base, score, '{f}' AS feature, {f} AS value, phi_{f} AS phi FROM scored"
    for f in WEIGHTS)})"""


LINEAR = _phi_sql()
ID_OUT = ", ".join(IDS)


@query(
    "linear_shap",
    f"WITH {LINEAR} SELECT {ID_OUT}, {r6('base')} AS base, "
    + ", ".join(f"{r6(f'phi_{f}')} AS phi_{f}" for f in WEIGHTS)
    + " FROM scored",
)
def linear_shap(spark, d):
    phi = F.col("contributions")
    return linear(spark, d).select(
        *IDS, "base", *[phi[i]["phi"].alias(f"phi_{f}") for i, f in enumerate(WEIGHTS)]
    )


@query(
    "shap_global",
    f"WITH {LINEAR} SELECT feature, {r6('avg(abs(phi))')} AS importance FROM long GROUP BY 1 "
    "ORDER BY avg(abs(phi)) DESC LIMIT 3",
)
def shap_global(spark, d):
    return explain.shap_global(linear(spark, d), list(WEIGHTS), top_k=3)


ORDERED = "row_number() OVER (PARTITION BY {ids} ORDER BY abs(phi) {direction}, feature)".format


@query(
    "shap_local_top5",
    f"WITH {LINEAR} SELECT {ID_OUT}, CAST(rank AS INTEGER) AS rank, feature, {r6('value')} AS value, "
    f"{r6('phi')} AS phi FROM (SELECT *, {ORDERED(ids=ID_OUT, direction='DESC')} AS rank FROM long) "
    "WHERE rank <= 5",
)
def shap_local_top5(spark, d):
    return explain.shap_local_top(linear(spark, d), IDS, 5)


@query(
    "waterfall_steps",
    f"WITH {LINEAR}, steps AS (SELECT *, {ORDERED(ids=ID_OUT, direction='ASC')} AS step FROM long), "
    f"running AS (SELECT *, base + sum(phi) OVER (PARTITION BY {ID_OUT} ORDER BY step) AS stop FROM steps) "
    f"SELECT {ID_OUT}, CAST(step AS INTEGER) AS step, feature, {r6('phi')} AS phi, "
    f"{r6('stop - phi')} AS start, {r6('stop')} AS stop FROM running",
)
def waterfall_steps(spark, d):
    return explain.waterfall_steps(linear(spark, d), IDS)


@query(
    "high_risk_explanations",
    f"WITH {LINEAR}, ranked AS (SELECT *, {ORDERED(ids=ID_OUT, direction='DESC')} AS rank FROM long "
    f"WHERE score >= 0.5) SELECT {ID_OUT}, {r6('max(score)')} AS prediction_proba, "
    "string_agg(feature, ',' ORDER BY rank) AS top_features FROM ranked WHERE rank <= 5 "
    f"GROUP BY {ID_OUT}",
)
def high_risk_explanations(spark, d):
    found = explain.high_risk_explanations(
        linear(spark, d), "event_id", F.lit("2024-01-01").cast("timestamp")
    )
    return found.select(
        *IDS, "prediction_proba", F.concat_ws(",", "top_features.feature").alias("top_features")
    )


REPORT = """WITH {linear}, ranked AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY abs(phi) DESC, feature) AS rank
  FROM long),
blocks AS (SELECT event_id, any_value(base) AS base, any_value(score) AS score, string_agg(printf('%d. %s
   - value %s
   - share %+.3f, which %s the score
', rank, feature, coalesce(printf('%.2f', value), 'missing'), phi, CASE WHEN phi > 0 THEN 'increases' ELSE 'decreases' END), chr(10) ORDER BY rank) AS text
  FROM ranked WHERE rank <= 5 GROUP BY event_id)
SELECT event_id, printf('# Why this score
Entity %s, written 2024-01-01 00:00:00

- score %.3f (%s)
- score without any feature %.3f

## Largest shares
', CAST(event_id AS VARCHAR), score, CASE WHEN score > 0.5 THEN 'High' WHEN score > 0.25 THEN 'Medium' ELSE 'Low' END, base)
  || chr(10) || text || chr(10) || '## How to read this
Shares above zero raise the score and shares below zero lower it. They describe the model, not causes,
and do not replace a clinician''s judgement.' AS report FROM blocks"""


@query("explanation_text", REPORT.replace("{linear}", LINEAR))
def explanation_text(spark, d):
    text = explain.explanation_text(
        F.col("prediction_proba"), F.col("base"), F.col("contributions"), F.col("event_id"),
        F.lit("2024-01-01").cast("timestamp"),
    )
    return linear(spark, d).select(*IDS, text.alias("report"))


# The classifier: trained on three quarters of the panel, scored on the rest.

FEATURES = list(defaults.FEATURES)
KEYS = ["patient", "as_of"]
SMALL = {"maxIter": 10, "maxDepth": 4, "minInstancesPerNode": 20, "stepSize": 0.1}


@lru_cache(maxsize=4)
def _fitted(spark: SparkSession, d: str):
    """(model, validation rows): several queries explain and score the same model."""
    rows = scratch.settle(panel.training_rows(spark, d), "training")
    # The fit and all queries on the held-out rows read the split, so it is stored too.
    split = scratch.settle(train.stratified_split(rows, KEYS), "split")
    scratch.discard(rows)
    model = train.fit_classifier(split.where(~F.col("is_validation")), FEATURES, **SMALL)
    return model, split.where("is_validation").drop("is_validation")


def validation_scores(spark: SparkSession, d: str) -> DataFrame:
    model, held_out = _fitted(spark, d)
    return train.score(model, held_out, FEATURES)


VALIDATION_SQL = f"""WITH {panel.SQL_INDEX},{panel.SQL_LABELS},
split AS (SELECT *, count(*) OVER (PARTITION BY label_90d) AS n, row_number() OVER
  (PARTITION BY label_90d ORDER BY md5('42:' || patient || ':' || CAST(as_of AS VARCHAR))) AS k
  FROM labels),
held_out AS (SELECT patient, as_of, label_90d FROM split WHERE k <= ceil(0.25::DOUBLE * n))"""


@query("gbt_train_score")
def gbt_train_score(spark, d):
    return validation_scores(spark, d).select(
        *KEYS, "label_90d", "prediction_proba", "prediction"
    )


def _held_out_sql(columns: str) -> str:
    return f"{VALIDATION_SQL} SELECT patient, as_of_text AS as_of, {columns} FROM (SELECT *, " \
        f"{ts('as_of')} AS as_of_text FROM held_out)"


@query("gbt_score_checked", _held_out_sql("label_90d, 1 AS in_range, 1 AS class_fits"))
def gbt_score_checked(spark, d):
    """What must hold of the score of every held-out row."""
    p = F.col("prediction_proba")
    return validation_scores(spark, d).select(
        *KEYS, "label_90d", p.between(0, 1).alias("in_range"), ((p > 0.5) == (F.col("prediction") == 1)).alias("class_fits")
    )


@query("gbt_importance_checked", "SELECT 8 AS n_features, 8 AS n_in_range, 1.0::DOUBLE AS total FROM region LIMIT 1")
def gbt_importance_checked(spark, d):
    """Shares of all features, which make up one."""
    found = train.feature_importance(_fitted(spark, d)[0], FEATURES, spark, top=None)
    return found.agg(
        F.count("*").cast("int").alias("n_features"),
        F.count_if(F.col("importance").between(0, 1)).cast("int").alias("n_in_range"),
        F.sum("importance").alias("total"),
    )


@query("gbt_importance")
def gbt_importance(spark, d):
    return train.feature_importance(_fitted(spark, d)[0], FEATURES, spark)


@query(
    "model_roundtrip",
    f"{VALIDATION_SQL} SELECT count(*) AS n_rows, 0.0::DOUBLE AS largest_change FROM held_out",
)
def model_roundtrip(spark, d):
    """The largest score change after saving and loading the model: none."""
    model, held_out = _fitted(spark, d)
    path = scratch.scratch_path(spark, "classifier")
    models.save_model(model, path)
    before = train.score(model, held_out, FEATURES).select(*KEYS, F.col("prediction_proba").alias("a"))
    after = train.score(models.load_classifier(path), held_out, FEATURES)
    both = before.join(dealt(after.select(*KEYS, F.col("prediction_proba").alias("b"))), KEYS)
    return both.agg(
        F.count("*").alias("n_rows"), F.max(F.abs(F.col("a") - F.col("b"))).alias("largest_change")
    )


@query("score_calibrated")
def score_calibrated(spark, d):
    scored = validation_scores(spark, d)
    path = scratch.scratch_path(spark, "calibrator")
    models.save_calibrator(calibrate.fit_isotonic(scored), path)
    calibrated = calibrate.apply_isotonic(models.load_calibrator(spark, path), scored)
    return calibrated.select(*KEYS, "prediction_proba", "prediction_calibrated")


@query(
    "score_calibrated_checked",
    f"{VALIDATION_SQL} SELECT count(*) AS n, count(*) AS n_in_range, 0 AS n_out_of_order, "
    f"{r6('avg(label_90d)')} AS mean_calibrated FROM held_out",
)
def score_calibrated_checked(spark, d):
    """Calibrated scores rise with the raw ones and have the labels' mean."""
    scored = scratch.settle(validation_scores(spark, d), "scored")
    found = calibrate.apply_isotonic(calibrate.fit_isotonic(scored), scored)
    # A window per tenth of the raw score; equal scores must have equal levels.
    ordered = Window.partitionBy(F.floor(F.col("prediction_proba") * 10)).orderBy("prediction_proba")
    before = F.lag("prediction_calibrated").over(ordered)
    falls = found.select((F.col("prediction_calibrated") < before - 1e-9).alias("falls")).agg(F.count_if("falls"))
    c = F.col("prediction_calibrated")
    return found.agg(
        F.count("*").alias("n"), F.count_if(c.between(0, 1)).alias("n_in_range"),
        falls.scalar().cast("int").alias("n_out_of_order"), F.avg(c).alias("mean_calibrated"),
    )


def _trees(spark: SparkSession, d: str):
    model, held_out = _fitted(spark, d)
    return load_forest(spark, model.stages[-1]), train.assembled(model, held_out, FEATURES)


def _phi_columns(explained: DataFrame) -> DataFrame:
    phi = F.col("contributions")
    return explained.select(
        *KEYS, "base", *[phi[i]["phi"].alias(f"phi_{f}") for i, f in enumerate(FEATURES)]
    )


@query("tree_shap")
def tree_shap(spark, d):
    forest, rows = _trees(spark, d)
    return _phi_columns(explain.tree_shap(rows, forest, FEATURES))


@query("kernel_shap")
def kernel_shap(spark, d):
    forest, rows = _trees(spark, d)
    background = explain.background_sample(rows, KEYS)
    cores = spark.sparkContext.defaultParallelism
    explained = explain.kernel_shap(
        rows, forest.probability, background, FEATURES, partitions=cores
    )
    return _phi_columns(explained)


@query("kernel_shap_checked", _held_out_sql("1 AS adds_up, 8 AS n_features"))
def kernel_shap_checked(spark, d):
    """Base and contributions of every held-out row make up its score."""
    forest, rows = _trees(spark, d)
    background = explain.background_sample(rows, KEYS)
    explained = explain.kernel_shap(
        rows, forest.probability, background, FEATURES, partitions=spark.sparkContext.defaultParallelism
    )
    gap = F.abs(explain.total(F.col("contributions"), F.col("base")) - F.col("prediction_proba"))
    return explained.select(*KEYS, (gap < 1e-6).alias("adds_up"), F.size("contributions").alias("n_features"))


@query("tree_shap_checked", _held_out_sql("1 AS adds_up, 8 AS n_features"))
def tree_shap_checked(spark, d):
    """Base and contributions of every held-out row make up its margin."""
    forest, rows = _trees(spark, d)
    explained = explain.tree_shap(rows, forest, FEATURES)
    gap = F.abs(explain.total(F.col("contributions"), F.col("base")) - F.col("margin"))
    return explained.select(*KEYS, (gap < 1e-6).alias("adds_up"), F.size("contributions").alias("n_features"))


def _explained(spark: SparkSession, d: str) -> DataFrame:
    forest, rows = _trees(spark, d)
    return explain.tree_shap(rows, forest, FEATURES)


@query("tree_global_checked", "SELECT 8 AS n_features, 1 AS falls, 1 AS all_found FROM region LIMIT 1")
def tree_global_checked(spark, d):
    """The features of the fitted trees by mean size of their contributions."""
    ranked = explain.shap_global(_explained(spark, d), FEATURES)
    sizes = ranked.agg(F.collect_list("importance").alias("s"), F.array_sort(F.collect_set("feature")).alias("f"))
    return sizes.select(
        F.size("s").alias("n_features"),
        (F.col("s") == F.reverse(F.array_sort("s"))).alias("falls"),
        (F.col("f") == F.array_sort(F.array(*map(F.lit, FEATURES)))).alias("all_found"),
    )


@query("tree_local_checked", _held_out_sql("5 AS n, 1 AS falls, 1 AS are_largest"))
def tree_local_checked(spark, d):
    """The five largest contributions of every held-out row against all eight."""
    rows = scratch.settle(_explained(spark, d), "explained")
    top = explain.shap_local_top(rows, KEYS, 5).groupBy(*KEYS).agg(
        F.count("*").cast("int").alias("n"), F.sort_array(F.collect_list(F.struct("rank", F.abs("phi").alias("size")))).alias("t")
    )
    sizes = F.reverse(F.array_sort(F.transform("contributions", lambda c: F.abs(c["phi"]))))
    both = top.join(dealt(rows.select(*KEYS, F.slice(sizes, 1, 5).alias("largest"))), KEYS)
    found = F.col("t.size")
    return both.select(*KEYS, "n", (found == F.reverse(F.array_sort(found))).alias("falls"), (found == F.col("largest")).alias("are_largest"))


@query("tree_waterfall_checked", _held_out_sql("8 AS n_steps, 1 AS ends_at_margin, 1 AS joined"))
def tree_waterfall_checked(spark, d):
    """Steps of every held-out row: each starts where the one before stops, the last stops at the margin."""
    rows = scratch.settle(_explained(spark, d), "explained")
    steps = explain.waterfall_steps(rows, KEYS).groupBy(*KEYS).agg(F.sort_array(F.collect_list(F.struct("step", "start", "stop"))).alias("s"))
    both = steps.join(dealt(rows.select(*KEYS, "margin")), KEYS)
    joined = F.forall(F.sequence(F.lit(2), F.size("s")), lambda i: F.element_at("s", i)["start"] == F.element_at("s", i - 1)["stop"])
    ends = F.abs(F.element_at("s", -1)["stop"] - F.col("margin")) < 1e-6
    return both.select(*KEYS, F.size("s").alias("n_steps"), ends.alias("ends_at_margin"), joined.alias("joined"))


@query("tree_reports_checked", _held_out_sql("1 AS whole"))
def tree_reports_checked(spark, d):
    """A report on every held-out row: its subject, five numbered features and the closing words."""
    rows = explain.high_risk_explanations(
        _explained(spark, d), "patient", F.lit("2024-01-01").cast("timestamp"), threshold=0.0
    )
    text = F.col("report")
    whole = text.contains(F.concat(F.lit("Entity "), F.col("patient").cast("string"), F.lit(", written 2024-01-01")))
    for i in range(1, 6):
        named = F.concat(F.lit(f"\n{i}. "), F.element_at("top_features", i)["feature"], F.lit("\n"))
        whole = whole & text.contains(named)
    return rows.select(*KEYS, (whole & text.endswith("judgement.")).alias("whole"))


# The linear score again, explained as if nothing were known of it: no gaps, and means of the background.
PLAIN = {f: w for f, w in WEIGHTS.items() if f != "item"}


@query(
    "kernel_shap_linear",
    """WITH rows AS (SELECT event_id, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, hour(ts) AS hour
  FROM events),
means AS (SELECT avg(value) AS value, avg(k) AS k, avg(hour) AS hour FROM (
  SELECT * FROM rows ORDER BY md5('42:' || CAST(event_id AS VARCHAR)), event_id LIMIT 50))
SELECT event_id, """
    + r6("0.3 - 0.0123456789123457::DOUBLE * m.value + 0.0198761234598761::DOUBLE * m.k + 0.0317171698317171::DOUBLE * m.hour")
    + " AS base, "
    + r6("-0.0123456789123457::DOUBLE * (r.value - m.value)") + " AS phi_value, "
    + r6("0.0198761234598761::DOUBLE * (r.k - m.k)") + " AS phi_k, "
    + r6("0.0317171698317171::DOUBLE * (r.hour - m.hour)") + " AS phi_hour FROM rows r, means m",
)
def kernel_shap_linear(spark, d):
    """Contributions to a linear score, found from its values alone; the closed form is weight x (value - mean)."""
    key = F.col("event_id")
    rows = table(spark, d, "events").select(
        key,
        F.col("value").cast("double").alias("value"),
        F.get_json_object("props", "$.k").cast("double").alias("k"),
        F.hour("ts").cast("double").alias("hour"),
    )
    rows = rows.withColumn("inputs", F.array(*PLAIN))
    background = explain.background_sample(rows, IDS, 50)
    weights, intercept = np.array(list(PLAIN.values())), INTERCEPT
    explained = explain.kernel_shap(rows, lambda inputs: inputs @ weights + intercept, background, list(PLAIN))
    phi = F.col("contributions")
    return explained.select(*IDS, "base", *[phi[i]["phi"].alias(f"phi_{f}") for i, f in enumerate(PLAIN)])


@query(
    "shap_additivity",
    f"{VALIDATION_SQL} SELECT count(*) AS n, 0.0::DOUBLE AS max_error, 1 AS passed FROM held_out",
)
def shap_additivity(spark, d):
    """Contributions of every held-out row add up to its margin."""
    forest, rows = _trees(spark, d)
    return explain.shap_additivity(explain.tree_shap(rows, forest, FEATURES))
