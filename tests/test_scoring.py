"""Metrics, calibration, splits, drift tests, fairness and monitoring."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortflow import defaults
from cohortflow.functions import bins, pvalues, ranks
from cohortflow.functions.scalars import confidence, erfc, risk_band
from cohortflow.operators import (
    calibrate, drift, evaluate, fairness, performance, quality, report, train,
)

SCORED = "p double, y int"


def scored(spark, p, y):
    return spark.createDataFrame(list(zip(p, y)), SCORED)


def metrics_of(df, **kw):
    out = {}
    for f, column in (
        (evaluate.auroc, "auroc"), (evaluate.average_precision, "average_precision")
    ):
        out[column] = f(df, ["p"], "y", **kw).first()[column]
    out["brier"] = evaluate.brier(df, ["p"], "y").first()["brier"]
    return out


def test_perfect_scores(spark):
    found = metrics_of(scored(spark, [0.1, 0.2, 0.8, 0.9], [0, 0, 1, 1]))
    assert found == pytest.approx({"auroc": 1.0, "average_precision": 1.0, "brier": 0.025})


def test_single_class_has_no_auroc(spark):
    found = metrics_of(scored(spark, [0.9, 0.8, 0.7, 0.6], [1, 1, 1, 1]))
    assert found["auroc"] is None and found["average_precision"] == pytest.approx(1.0)
    assert evaluate.roc_curve(scored(spark, [0.9, 0.8], [1, 1]), "p", "y").count() == 0


def evaluate_range(df):
    return {r["label"]: r["max_score"] for r in calibrate.score_range(df, "p", "y").collect()}


def test_nan_scores_and_values_are_missing(spark):
    nan = float("nan")
    df = scored(spark, [nan, 0.9, 0.1], [1, 1, 0])
    level = evaluate.confusion_at_thresholds(df, {"half": 0.5}, "p", "y").first()
    assert (level["tp"], level["fp"], level["fn"], level["tn"]) == (1, 0, 0, 1)
    assert evaluate.brier(df, ["p"], "y").first()["brier"] == pytest.approx(0.01)
    assert quality.feature_completeness(df, ["p"]).first()["n_missing"] == 1
    grouped = spark.createDataFrame([("a", nan, 1), ("a", 0.5, 0)], "g string, p double, y int")
    assert fairness.bias_group_stats(grouped, ["g"], "p", "y").first()["prediction_mean"] == 0.5
    assert train.with_missing_flags(df, ["p"]).where("p_missing = 1").count() == 1
    banded = df.select(risk_band(F.col("p")).alias("b"), confidence(F.col("p")).alias("c"))
    assert banded.where("b IS NULL AND c IS NULL").count() == 1
    worse = performance.metric_degradation(
        spark.createDataFrame([("auroc", 0.8)], "metric string, value double"),
        spark.createDataFrame([("auroc", nan)], "metric string, value double"),
    )
    assert worse.where("degraded").count() == 0
    tops = evaluate_range(df)
    assert tops == {0: 0.1, 1: 0.9}


def brute(p, y):
    pairs = [(a, b) for a, ya in zip(p, y) if ya for b, yb in zip(p, y) if not yb]
    auroc = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in pairs) / len(pairs)
    ap = seen = hits = 0
    for s in sorted(set(p), reverse=True):
        here = [b for a, b in zip(p, y) if a == s]
        seen, hits = seen + len(here), hits + sum(here)
        ap += sum(here) / sum(y) * hits / seen
    return auroc, ap


@pytest.mark.parametrize("parts", [10, 100_000])
def test_ranks_match_brute_force_in_any_number_of_buckets(spark, parts):
    rng = random.Random(1)
    # A third of all rows share one score.
    p = [0.5 if rng.random() < 0.34 else rng.randrange(60) / 60 for _ in range(300)]
    y = [int(rng.random() < 0.3 + 0.4 * a) for a in p]
    df = scored(spark, p, y)
    found = metrics_of(df, parts=parts)
    auroc, ap = brute(p, y)
    assert found["auroc"] == pytest.approx(auroc) and found["average_precision"] == pytest.approx(ap)
    flipped = df.withColumn("p", 1 - F.col("p"))
    assert metrics_of(flipped, parts=parts)["auroc"] == pytest.approx(1 - auroc)
    curve = sorted((r["fpr"], r["tpr"]) for r in evaluate.roc_curve(
        df, "p", "y", parts).collect())
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip([(0, 0), *curve], curve))
    assert area == pytest.approx(auroc)


@pytest.mark.parametrize("parts", [1, 7, 300])
def test_exact_quantiles(spark, parts):
    rng = random.Random(4)
    values = [rng.choice([1.0, rng.uniform(0, 9)]) for _ in range(101)] + [None, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    totals = ranks.ranked_values(df, ["v"], {"n": F.lit(1)}, parts)
    found = ranks.exact_quantiles(totals, "n", {"a": 0.25, "b": 0.5, "c": 0.9, "d": 1.0}).first()
    expected = np.quantile(values[:101], [0.25, 0.5, 0.9, 1.0])
    assert list(found)[1:] == pytest.approx(list(expected))


@pytest.mark.parametrize("parts", [1, 500])
def test_running_totals_whatever_the_number_of_ranges(spark, parts):
    df = spark.range(3_000).select((F.col("id") % 1_500 * 1.0).alias("v"), (F.col("id") * -1.0).alias("u"))
    table = ranks.value_table(df, ["v", "u"], {"n": F.lit(1).cast("long")}, parts)
    assert table.select("part").distinct().count() > parts / 2
    found = ranks.running_totals(table, ["n"])
    wrong = found.where(F.when(F.col("series") == "v", F.col("value") * 2).otherwise(F.col("value") + 2_999) != F.col("n_below"))
    assert found.count() == 4_500 and wrong.count() == 0
    assert {r["n_all"] for r in found.collect()} == {3_000}


def test_moments_of_a_value_table(spark):
    rng = np.random.default_rng(6)
    values = (1e9 + rng.integers(0, 5, 200)).tolist() + [None, float("nan"), float("nan")]
    rows = [(v, v if i % 2 else None, int(i % 3 == 0)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "a double, b double, w int")
    df = df.withColumn("none", F.lit(None).cast("double"))
    table = ranks.value_table(df, ["a", "b", "none"], {"w": F.col("w"), "n": F.lit(1)})
    found = {r["series"]: r for r in ranks.moments(table, ["w", "n"]).collect()}
    whole = np.array(values[:200])
    a, own = found["a"], whole[::3]
    assert (a["n_count"], a["n_missing"], a["w_count"]) == (200, 3, len(own))
    assert (a["n_mean"], a["n_std"]) == pytest.approx((whole.mean(), whole.std(ddof=1)), rel=1e-12)
    assert (a["w_mean"], a["w_std"], a["w_min"], a["w_max"]) == pytest.approx((own.mean(), own.std(ddof=1), own.min(), own.max()))
    assert found["b"]["n_count"] == 100 and found["b"]["n_missing"] == 103
    assert found["none"]["n_count"] == 0 and found["none"]["n_mean"] is None and found["none"]["n_std"] is None


def test_confusion_at_thresholds(spark):
    df = scored(spark, [0.1, 0.2, 0.3, 0.4, 0.6, 0.7, 0.8, 0.9], [0, 0, 0, 1, 1, 1, 1, 1])
    found = evaluate.threshold_metrics(
        evaluate.confusion_at_thresholds(df, {"a": 0.3, "b": 0.5, "c": 0.7, "never": 2.0}, "p", "y")
    )
    rows = {r["name"]: r for r in found.collect()}
    cells = {n: (r["tn"], r["fp"], r["fn"], r["tp"]) for n, r in rows.items()}
    assert cells == {"a": (2, 1, 0, 5), "b": (3, 0, 1, 4), "c": (3, 0, 2, 3), "never": (3, 0, 5, 0)}
    assert rows["never"]["ppv"] == 0.0 and rows["never"]["f1"] == 0.0
    assert rows["b"]["sensitivity"] == pytest.approx(0.8)


def test_sweep_covers_both_ends():
    cuts = list(evaluate.sweep_thresholds().values())
    assert len(cuts) == 50 and cuts[0] == 0.1 and cuts[-1] == pytest.approx(0.9)


def test_metrics_report_and_gate(spark):
    df = scored(spark, [0.1, 0.2, 0.8, 0.9], [0, 0, 1, 1]).withColumn("c", F.col("p"))
    metrics = evaluate.metrics_row(df, "p", "c", "y")
    confusion = evaluate.threshold_metrics(
        evaluate.confusion_at_thresholds(df, {"high": 0.45, "low": 0.25}, "c", "y")
    )
    document = evaluate.metrics_report(metrics, confusion).first()
    assert document["metrics"]["auroc_raw"] == 1.0
    assert document["confusion_matrices"]["high"]["confusion_matrix"]["tp"] == 2
    assert all(evaluate.quality_gate(metrics).first())


def test_isotonic_matches_pooling_by_hand(spark):
    df = scored(spark, [0.1, 0.2, 0.2, 0.3, 0.4, 0.5], [0, 1, 0, 0, 1, 1])
    model = calibrate.fit_isotonic(df, "p", "y")
    asked = spark.createDataFrame([(0.0,), (0.1,), (0.2,), (0.3,), (0.35,), (0.4,), (0.9,)], "p double")
    found = [r["c"] for r in calibrate.apply_isotonic(model, asked, "p", "c").collect()]
    assert found == pytest.approx([0, 0, 1 / 3, 1 / 3, 2 / 3, 1, 1])


def test_unit_bins_follow_numpy_edges(spark):
    edges = np.linspace(0, 1, 11)
    values = sorted({float(v) for e in edges for v in (e, np.nextafter(e, 0), np.nextafter(e, 1))}
                    | {0.3, 0.6, 0.7})
    df = spark.createDataFrame([(v,) for v in values], "v double").select(
        "v", bins.unit_bin_left_closed(F.col("v")).alias("l"),
        bins.unit_bin_right_closed(F.col("v")).alias("r"),
    )
    for row in df.collect():
        left = [i for i in range(10) if edges[i] <= row["v"] < edges[i + 1]]
        right = [i for i in range(10) if edges[i] < row["v"] <= edges[i + 1]]
        assert row["l"] == (left[0] if left else None), row
        assert row["r"] == (right[0] if right else None), row


def test_bins_follow_numpy_histogram(spark):
    rng = np.random.default_rng(0)
    values = np.concatenate([rng.normal(3, 2, 500), np.round(rng.normal(3, 2, 300), 1)])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    low, high = F.lit(float(values.min())), F.lit(float(values.max()))
    found = {r[0]: r[1] for r in df.groupBy(bins.bin_of(F.col("v"), low, high, 30)).count().collect()}
    counts, _ = np.histogram(values, bins=30)
    assert [found.get(i, 0) for i in range(30)] == counts.tolist()


def test_erfc(spark):
    xs = [i / 50 for i in range(300)]
    df = spark.createDataFrame([(x,) for x in xs], "x double").select("x", erfc(F.col("x")))
    assert max(abs(r[1] - math.erfc(r[0])) for r in df.collect()) < 1.5e-7


def test_kolmogorov_tail(spark):
    df = spark.createDataFrame([(0.0,), (0.19,), (0.21,), (0.8276,), (1.3581,)], "x double")
    found = [r[0] for r in df.select(pvalues.kolmogorov_tail(F.col("x"))).collect()]
    assert found == pytest.approx([1, 1, 1, 0.5, 0.05], abs=1e-4)


@pytest.fixture(scope="module")
def both_sides(spark):
    rng = np.random.default_rng(42)
    ref = [(float(a), float(b), None) for a, b in zip(rng.poisson(12, 100), rng.normal(7, 1, 100))]
    cur = [(float(a), float(b), None) for a, b in zip(rng.poisson(12, 80), rng.normal(8, 1, 80))]
    schema = "count double, level double, empty double"
    return ref, cur, spark.createDataFrame(ref, schema), spark.createDataFrame(cur, schema)


def brute_tests(a, b):
    a, b = np.array(a), np.array(b)
    every = np.unique(np.concatenate([a, b]))
    distance = max(abs((a <= v).mean() - (b <= v).mean()) for v in every)
    u = sum((x > b).sum() + 0.5 * (x == b).sum() for x in a)
    return distance, u


def psi_of(a, b):
    _, edges = np.histogram(a, bins=10)
    edges[0], edges[-1] = min(edges[0], min(b)), max(edges[-1], max(b))
    r, c = (np.histogram(x, bins=edges)[0] / len(x) for x in (a, b))
    r, c = (np.where(x == 0, 0.0001, x) for x in (r, c))
    return float(np.sum((c - r) * np.log(c / r)))


@pytest.mark.parametrize("parts", [10, 100_000])
def test_drift(spark, both_sides, parts):
    ref, cur, reference, current = both_sides
    names = drift.monitored_features(reference)
    changes = drift.feature_drift(reference, current, names, parts=parts)
    found = {r["feature"]: r for r in changes.collect()}
    assert set(found) == {"count", "level"}
    for i, name in enumerate(("count", "level")):
        a, b = [r[i] for r in ref], [r[i] for r in cur]
        distance, u = brute_tests(a, b)
        assert found[name]["ks_statistic"] == pytest.approx(distance)
        assert found[name]["mw_statistic"] == pytest.approx(u)
        assert found[name]["psi"] == pytest.approx(psi_of(a, b))
    assert found["level"]["drift_detected"]
    drifted = sum(r["drift_detected"] for r in found.values())
    summary = drift.drift_summary(changes, len(names)).first()
    assert tuple(summary) == (3, drifted, pytest.approx(drifted / 3), True)


def test_a_table_does_not_drift_from_itself(both_sides):
    reference = both_sides[2]
    changes = drift.feature_drift(reference, reference, ["count", "level"]).collect()
    for row in changes:
        assert row["ks_statistic"] == 0 and row["psi"] == pytest.approx(0, abs=1e-12)
        assert row["ks_p_value"] == 1 and row["mw_p_value"] > 0.99 and not row["drift_detected"]


def test_reference_stats(both_sides):
    ref, _, reference, _ = both_sides
    found = {r["feature"]: r for r in drift.reference_stats(
        reference, ["level", "empty"], parts=20).collect()}
    values = np.array([r[1] for r in ref])
    assert found["level"]["std"] == pytest.approx(values.std(ddof=1))
    assert found["level"]["q25"] == pytest.approx(np.quantile(values, 0.25))
    assert found["empty"]["count"] == 0 and found["empty"]["missing_rate"] == 1.0


def test_constant_reference_is_widened(spark):
    a = spark.createDataFrame([(5.0,)] * 10, "v double")
    b = spark.createDataFrame([(5.0,)] * 9 + [(9.0,)], "v double")
    assert drift.psi(a, b, ["v"]).first()["psi"] == pytest.approx(psi_of([5.0] * 10, [5.0] * 9 + [9.0]))


def test_box_statistics(spark):
    values = [*map(float, range(1, 12)), 40.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    row = quality.feature_boxstats(df, ["v"], parts=3).first()
    assert (row["low_whisker"], row["high_whisker"], row["n_outliers"]) == (1.0, 11.0, 1)
    assert row["median"] == pytest.approx(np.median(values))


METRIC = "metric string, value double"


def degradation(spark, current):
    baseline = {"auroc": 0.75, "auprc": 0.60, "brier_score": 0.20, "accuracy": 0.70}
    return performance.metric_degradation(
        spark.createDataFrame(list(baseline.items()), METRIC),
        spark.createDataFrame(list(current.items()), METRIC),
    )


def test_degradation(spark):
    good = degradation(spark, {"auroc": 0.76, "auprc": 0.61, "brier_score": 0.19, "accuracy": 0.71})
    assert not performance.degradation_summary(good).first()["degradation_detected"]
    bad = degradation(
        spark, {"auroc": 0.68, "auprc": 0.52, "brier_score": 0.28, "accuracy": 0.65, "new": 1.0}
    )
    assert {r["metric"] for r in bad.where("degraded").collect()} == {"auroc", "auprc", "brier_score"}
    summary = performance.degradation_summary(bad).first()
    assert summary["alerts"][1] == (
        "Performance degradation detected in auroc: 0.750 → 0.680 (change: +0.070)"
    )


@pytest.mark.parametrize(
    "values, trend",
    [([0.7], "insufficient_data"), ([0.7, 0.7005], "stable"), ([0.7, 0.8], "improving"),
     ([0.9] + [0.5 + 0.01 * i for i in range(10)], "improving")],
)
def test_trend(spark, values, trend):
    opposite = {"improving": "degrading"}.get(trend, trend)
    rows = [(m, i, v) for m in ("auroc", "brier_score") for i, v in enumerate(values)]
    history = spark.createDataFrame(rows, "metric string, seq bigint, value double")
    found = {r["metric"]: r["trend"] for r in performance.metric_trend(history).collect()}
    assert found == {"auroc": trend, "brier_score": opposite}


def test_bias(spark):
    rows = [("f", 0.4, 1), ("f", 0.2, 0), ("m", 0.6, 1), ("m", 0.8, 1), (None, 0.9, 1)]
    df = spark.createDataFrame(rows, "gender string, prediction_proba double, label_90d int")
    groups = fairness.bias_group_stats(df, ["gender", "age_group"])
    assert {r["group"]: r["n"] for r in groups.collect()} == {"f": 2, "m": 2}
    metrics = fairness.bias_metrics(groups)
    row = metrics.first()
    assert row["demographic_parity_diff"] == pytest.approx(0.4) and row["bias_detected"]
    assert row["prediction_variance"] == pytest.approx(0.04)
    assert tuple(fairness.bias_summary(metrics, 2).first()) == (2, 1, True)
    alone = fairness.bias_metrics(fairness.bias_group_stats(df.where("gender = 'f'"), ["gender"]))
    assert not alone.first()["bias_detected"]


def _summaries(spark, drifted, declined, biased):
    return (
        spark.createDataFrame([(4, 2, 0.5, drifted)],
                              "total_features int, drifted_features bigint, drift_rate double, "
                              "overall_drift_detected boolean"),
        spark.createDataFrame([(declined, ["down"] if declined else [])],
                              "degradation_detected boolean, alerts array<string>"),
        spark.createDataFrame([(1, 1, biased)],
                              "total_attributes int, biased_attributes bigint, bias_detected boolean"),
    )


@pytest.mark.parametrize(
    "findings, status, lowered, alerts",
    [((False, False, False), "healthy", "healthy", 0), ((True, False, False), "warning", "warning", 1),
     ((True, True, False), "critical", "critical", 2), ((False, True, True), "critical", "warning", 2)],
)
def test_monitoring_status(spark, findings, status, lowered, alerts):
    parts = _summaries(spark, *findings)
    row = report.monitoring_status(*parts).first()
    assert row["status"] == status and len(row["alerts"]) == alerts
    assert report.monitoring_status(*parts, reference_precedence=True).first()["status"] == lowered


def test_bands_and_confidence(spark):
    df = spark.createDataFrame([(0.5,), (0.25,), (0.1,), (1.0,), (None,)], "p double")
    p = F.col("p")
    found = [tuple(r) for r in df.select(risk_band(p), risk_band(p, True), confidence(p)).collect()]
    assert found == [
        ("high", "medium", 0.5), ("medium", "low", 0.75), ("low", "low", 0.9), ("high", "high", 1.0),
        (None, None, None),
    ]


def test_stratified_split(spark):
    df = spark.createDataFrame([(i, int(i % 10 < 3)) for i in range(1003)], "k int, label_90d int")
    split = train.stratified_split(df, ["k"])
    counts = {(r[0], r[1]): r[2] for r in split.groupBy("label_90d", "is_validation").count().collect()}
    for label in (0, 1):
        n = counts[(label, True)] + counts[(label, False)]
        assert counts[(label, True)] == math.ceil(0.25 * n)
    again = train.stratified_split(df.repartition(7), ["k"])
    assert split.where("is_validation").exceptAll(again.where("is_validation")).count() == 0
    other = train.stratified_split(df, ["k"], seed=7)
    assert split.where("is_validation").exceptAll(other.where("is_validation")).count() > 0


def test_stratified_split_cut_digit_by_digit(spark, monkeypatch):
    """The same rows, however few may be ranked; copies of one key stay together."""
    rows = [(i, int(i % 10 < 3)) for i in range(1003)] + [(5000, 1)] * 400 + [(7, None)] * 5
    df = spark.createDataFrame(rows, "k int, label_90d int")
    whole = train.stratified_split(df, ["k"]).groupBy("k", "label_90d", "is_validation").count().collect()
    for ranked, digits in ((20, 1), (1, 3), (0, 3)):
        monkeypatch.setattr(train, "RANKED_ROWS", ranked)
        monkeypatch.setattr(train, "PREFIX_DIGITS", digits)
        again = train.stratified_split(df, ["k"]).groupBy("k", "label_90d", "is_validation").count().collect()
        assert sorted(map(repr, again)) == sorted(map(repr, whole))
    assert len({r["is_validation"] for r in whole if r["k"] == 5000}) == 1
    assert not any(r["is_validation"] for r in whole if r["label_90d"] is None)


def test_folds_roll_forward(spark):
    rows = [(i, datetime(2024, 1, 1) + timedelta(days=i % 40)) for i in range(400)] + [(1, None)]
    df = spark.createDataFrame(rows, "k int, as_of timestamp")
    bounds = sorted(train.fold_bounds(df, 3).collect())
    assert [r["fold"] for r in bounds] == [1, 2, 3]
    days = [r["as_of"] for r in df.collect() if r["as_of"]]
    for r in bounds:
        assert r["n_train"] == sum(d < r["valid_from"] for d in days)
        assert r["n_valid"] == sum(r["valid_from"] <= d < r["valid_until"] for d in days)
    assert bounds[0]["valid_until"] == bounds[1]["valid_from"] and bounds[-1]["valid_until"] > max(days)
    assert train.fold_bounds(df.where("false"), 3).count() == 0
    single = train.fold_bounds(df.where("as_of = '2024-01-05'"), 2).collect()
    assert [(r["n_train"], r["n_valid"]) for r in sorted(single)] == [(10, 0), (10, 0)]


def test_folds_stop_early(spark):
    rng = np.random.default_rng(12)
    x = rng.normal(size=(1500, 2))
    y = (x[:, 0] + rng.normal(size=1500) > 0).astype(int)
    rows = [(float(a), float(b), int(t), datetime(2024, 1, 1) + timedelta(hours=i)) for i, ((a, b), t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "a double, b double, label_90d int, as_of timestamp")
    found = train.cross_validate(df, ["a", "b"], 2, maxIter=25, maxDepth=4, stepSize=0.5, minInstancesPerNode=5).collect()
    assert [r["fold"] for r in found] == [1, 2]
    for r in found:
        assert 0 < r["n_trees"] < 25 and r["auroc"] > 0.6 and 0 < r["brier"] < 0.4
    assert found[0]["n_train"] + found[0]["n_valid"] == found[1]["n_train"]
    one_class = train.cross_validate(df.withColumn("label_90d", F.lit(1)), ["a"], 2, maxIter=2).collect()
    assert [r["auroc"] for r in one_class] == [None, None]


def test_class_weights(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "label_90d int")
    weights = {r["label"]: r["weight"] for r in train.class_weights(df).collect()}
    assert weights == pytest.approx({0: 4 / 6, 1: 2.0})


def test_defaults_name_every_feature():
    assert set(defaults.FEATURE_RANGES) == set(defaults.FEATURES)
