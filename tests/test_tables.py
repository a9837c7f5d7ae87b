"""Merge, profiles, sources, run tables, requests."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cohortflow import defaults, schemas
from cohortflow.operators import merge, quality, runs, train, validate
from cohortflow.sources import reports, scratch, tables


@pytest.fixture
def training(spark):
    return spark.createDataFrame(
        [("patient1", "2024-06-01", 5, 7.2, 1), ("patient2", "2024-06-15", 3, 6.8, 0),
         ("patient3", "2024-07-01", 7, 7.5, 1)],
        "patient string, as_of string, n_observations_180d bigint, hba1c_last double, label_90d int",
    )


def test_target_correlation(training, rows):
    found = {r[0]: (round(r[1], 3), r[2]) for r in rows(
        quality.target_correlation(training, ["n_observations_180d", "hba1c_last"]))}
    assert found == {"n_observations_180d": (0.866, False), "hba1c_last": (0.904, True)}
    assert quality.target_like_columns(training) == []


def test_duplicate_keys(spark):
    df = spark.createDataFrame(
        [("p1", "2024-06-01"), ("p1", "2024-06-01"), ("p2", "2024-06-15")],
        "patient string, as_of string",
    )
    assert merge.duplicate_keys(df).first()[0] == 1
    assert merge.duplicate_keys(df.limit(0)).first()[0] == 0


def test_missing_columns_are_named(training):
    with pytest.raises(ValueError, match="as_of"):
        merge.merge_training(training.drop("as_of"), training)
    with pytest.raises(ValueError, match="label_90d"):
        train.feature_columns(training.drop("label_90d"))
    assert train.feature_columns(training) == ["n_observations_180d", "hba1c_last"]


def test_merge_drops_unknown_labels(spark, training):
    labels = spark.createDataFrame(
        [("patient1", "2024-06-01", 1), ("patient2", "2024-06-15", None), ("patient9", "x", 0)],
        "patient string, as_of string, label_90d int",
    )
    merged = merge.merge_training(training.drop("label_90d"), labels)
    assert [r["patient"] for r in merged.collect()] == ["patient1"]
    assert tuple(merge.key_overlap(training, labels).first()) == (2, 1, 1)


def test_completeness_of_an_empty_table(training, rows):
    found = rows(quality.feature_completeness(training.limit(0), ["hba1c_last"]))
    assert found == [("hba1c_last", None, 0, True)]


def test_histogram_of_a_constant_and_of_the_maximum(spark, rows):
    df = spark.createDataFrame([(3.0, float(i)) for i in range(31)], "c double, x double")
    found = {(r[0], r[1]): r[3] for r in rows(quality.feature_histogram(df, ["c", "x"]))}
    assert found[("c", 15)] == 31
    assert found[("x", 29)] == 2 and sum(n for (f, _), n in found.items() if f == "x") == 31


def test_csv_sources_are_typed(spark, tmp_path):
    path = tmp_path / "conditions.csv"
    path.write_text(
        "Start,Stop,Patient,Encounter,Code,Description,System\n"
        "2007-12-23,,patient_001,enc_1,44054006,Diabetes mellitus,SNOMED-CT\n"
    )
    df = tables.read_source(spark, str(tmp_path), "conditions")
    row = df.first()
    assert row["Code"] == "44054006" and row["Stop"] is None and str(row["Start"]) == "2007-12-23"
    assert tables.table_profile(df).where("n_null = 1").first()["column_name"] == "Stop"


def test_wrong_header_fails(spark, tmp_path):
    path = tmp_path / "conditions.csv"
    path.write_text("Stop,Start,Patient,Encounter,Code,Description,System\n,,p,e,1,d,s\n")
    with pytest.raises(Exception):
        tables.read_source(spark, str(tmp_path), "conditions").collect()


def test_report_round_trip(spark, tmp_path):
    document = spark.createDataFrame(
        [((0.75, 0.74, 0.6, 0.61, 0.2, 0.19),
          {"high_ppv": (0.45, (3, 0, 1, 4), (0.8, 1.0, 1.0, 0.75, 0.9))})],
        schemas.METRICS_REPORT,
    )
    path = str(tmp_path / "report")
    reports.write_report(document, path)
    assert reports.read_report(spark, path, schemas.METRICS_REPORT).collect() == document.collect()


def test_settle_ends_lineage(spark):
    df = scratch.settle(spark.range(10).withColumn("x", F.col("id") * 2), "t")
    assert df.count() == 10 and "Range" not in df._jdf.queryExecution().toString()


def request(**changes):
    row = dict(
        patient_id="p1", as_of_date="2024-01-01", n_observations_180d=25, n_encounters_180d=3,
        n_active_meds_180d=4, hba1c_last=7.2, hba1c_mean=7.1, hba1c_std=0.3, sbp_last=140.0,
        dbp_last=90.0,
    )
    row.update(changes)
    return row


REQUEST = (
    "patient_id string, as_of_date string, n_observations_180d int, n_encounters_180d int, "
    "n_active_meds_180d int, hba1c_last double, hba1c_mean double, hba1c_std double, "
    "sbp_last double, dbp_last double"
)


@pytest.mark.parametrize(
    "changes, errors",
    [
        ({}, []),
        ({"as_of_date": None, "hba1c_last": None, "sbp_last": None}, []),
        ({"as_of_date": "2024-1-5"}, []),
        ({"as_of_date": "2024-02-30"}, ["as_of_date:format"]),
        ({"as_of_date": "01/02/2024"}, ["as_of_date:format"]),
        ({"patient_id": ""}, ["patient_id:length"]),
        ({"patient_id": "x" * 101}, ["patient_id:length"]),
        ({"n_observations_180d": None}, ["n_observations_180d:missing"]),
        ({"n_observations_180d": 1001}, ["n_observations_180d:range"]),
        ({"hba1c_last": 2.9}, ["hba1c_last:range"]),
        ({"hba1c_mean": 10.3}, ["hba1c_mean:inconsistent"]),
        ({"sbp_last": 90.0}, ["dbp_last:not_below_sbp"]),
        ({"sbp_last": 59.0}, ["sbp_last:range"]),
    ],
)
def test_request_checks(spark, changes, errors):
    df = spark.createDataFrame([request(**changes)], REQUEST)
    row = validate.check_requests(df).first()
    assert row["errors"] == errors and row["valid"] == (not errors)


def test_batch_of_two(spark):
    df = spark.createDataFrame(
        [{**request(patient_id=p), "batch_id": "b"} for p in ("p1", "p2")],
        REQUEST + ", batch_id string",
    )
    checked = validate.check_requests(df)
    answered = validate.batch_response(checked, F.lit(0.4), F.lit(0.3))
    assert tuple(validate.batch_score_summary(answered).first()) == ("b", 2, 0)
    assert tuple(validate.batch_checks(df).first()) == ("b", 2, 0, True, True)
    twice = validate.batch_checks(df.union(df.limit(1))).first()
    assert not twice["unique_ok"] and twice["n_duplicate_ids"] == 1


def test_canonical_features_fill_gaps(spark):
    df = spark.createDataFrame([(1, 7.0)], "id int, hba1c_last double")
    found = validate.canonical_features(df, ["id"])
    assert found.columns == ["id", *defaults.FEATURES]
    assert found.first()["hba1c_last"] == 7.0 and found.first()["sbp_last"] is None


def test_runs(spark, tmp_path):
    path = str(tmp_path / "runs")
    start = datetime(2024, 1, 1)
    table = spark.createDataFrame(
        [("r1", "a", start, "FINISHED", {"learning_rate": "0.05", "seed": "1"},
          {"auroc": 0.85, "brier": float("nan")}, {}),
         ("r2", None, start, "FINISHED", {"max_depth": "5"}, {"auroc": 0.8, "brier": 0.18}, {}),
         ("r3", "c", start, "FAILED", {}, {"auroc": float("inf")}, {})],
        runs.RUNS,
    )
    first, rest = table.where("run_id = 'r1'"), table.where("run_id <> 'r1'")
    for rows, batch in ((first, "a"), (rest, "b"), (rest, "b"), (first, "a")):  # logged again, not twice
        runs.log_runs(rows, path, batch)
    stored = runs.read_runs(spark, path)
    assert stored.count() == 3
    assert runs.best_run(stored, "auroc").first()["run_id"] == "r1"
    assert runs.best_run(stored, "brier", ascending=True).first()["run_id"] == "r2"
    assert stored.where("run_id = 'r1'").first()["metrics"] == {"auroc": 0.85}
    wide = runs.compare_runs(stored, ["r1", "r2"], ["auroc", "brier"], ["learning_rate", "max_depth", "seed"])
    assert wide.columns[4:] == ["metric_auroc", "metric_brier", "param_learning_rate",
                                "param_max_depth", "param_seed"]
    assert {r["run_name"] for r in wide.collect()} == {"a", "Unknown"}
    every = runs.compare_experiment(stored, ["auroc"], ["learning_rate", "seed"])
    assert "param_seed" not in every.columns and "param_learning_rate" in every.columns
    entries = {(r["run_id"], r["kind"], r["key"]): r["text"] or r["number"] for r in runs.run_entries(stored).collect()}
    assert entries == {
        ("r1", "metric", "auroc"): 0.85, ("r2", "metric", "auroc"): 0.8, ("r2", "metric", "brier"): 0.18,
        ("r1", "param", "learning_rate"): "0.05", ("r1", "param", "seed"): "1", ("r2", "param", "max_depth"): "5",
    }
    assert {r["run_id"] for r in runs.run_entries(stored, ["r2"]).collect()} == {"r2"}


def test_a_batch_that_comes_again_replaces_itself(spark, tmp_path):
    from cohortflow.operators import performance

    path = str(tmp_path / "history")
    rows = spark.createDataFrame([("auroc", 1, 0.8), ("brier", 1, 0.2)], "metric string, seq bigint, value double")
    later = rows.withColumn("seq", rows.seq + 1).withColumn("value", rows.value / 2)
    at = F.lit("2024-01-02 03:04:05").cast("timestamp")
    for df, batch in ((rows, "one"), (later, "two"), (rows, "one"), (later, "two")):
        performance.append_measurements(df, path, batch, at, F.lit("fine"))
    history = performance.read_history(spark, path)
    assert history.count() == 4 and {r["analysis"] for r in history.collect()} == {"fine"}
    recent = {(r["metric"], r["back"]): (r["value"], str(r["measured_at"])) for r in performance.recent_measurements(history, 1).collect()}
    assert recent == {("auroc", 1): (0.4, "2024-01-02 03:04:05"), ("brier", 1): (0.1, "2024-01-02 03:04:05")}


def test_flatten(spark, rows):
    df = spark.createDataFrame([(1, ((5, "x"), [1, 2]))], "id int, c struct<a: struct<b: int, d: string>, e: array<int>>")
    assert rows(runs.flatten_params(df, "c", ["id"], "cfg_")) == [
        (1, "cfg_a_b", "5"), (1, "cfg_a_d", "x"), (1, "cfg_e", "[1, 2]")
    ]
