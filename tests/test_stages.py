"""The stages over source files, end to end."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortflow import __main__ as cli
from cohortflow import defaults, schemas
from cohortflow.operators.windows import shared_as_of
from cohortflow.plans import stages
from cohortflow.sources import tables
from cohortflow.sources.reports import read_report

REFERENCE_DATE = "2024-06-30"


def _write(folder, name, rows):
    header = [part.split()[0] for part in schemas.SOURCES[name].replace("\n", " ").split(",")]
    lines = [",".join(header)]
    lines += [",".join(str(row.get(column, "")) for column in header) for row in rows]
    (folder / f"{name}.csv").write_text("\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def sources(tmp_path_factory):
    folder, rng = tmp_path_factory.mktemp("sources"), np.random.default_rng(0)
    day = datetime.fromisoformat(REFERENCE_DATE)

    def moment(low, high):
        return (day + timedelta(minutes=int(rng.integers(low * 1440, high * 1440)))).isoformat(" ")

    patients, conditions, encounters, observations, medications = ([] for _ in range(5))
    for i in range(160):
        who, sick = f"p{i:03d}", rng.random() < 0.4
        patients.append({"Id": who, "BirthDate": f"{1950 + i % 70}-03-01", "Gender": "MF"[i % 2]})
        conditions.append({"Start": "2010-01-01", "Patient": who,
                           "Code": "44054006" if i % 10 else "1"})
        for _ in range(3):
            encounters.append({"Id": "e", "Start": moment(-200, 0), "Stop": moment(0, 1),
                               "Patient": who, "EncounterClass": "outpatient"})
        if sick:
            encounters.append({"Id": "e", "Start": moment(1, 89), "Stop": moment(89, 90),
                               "Patient": who, "EncounterClass": "Emergency"})
        for code, level in (("4548-4", 9 if sick else 6), ("8480-6", 130), ("8462-4", 80)):
            for _ in range(3):
                observations.append({"Date": moment(-179, 0), "Patient": who, "Code": code,
                                     "Value": f"{rng.normal(level, 0.5):.1f}"})
        medications.append({"Start": moment(-400, -10), "Patient": who, "Description": "Metformin"})
    for name, rows in (("patients", patients), ("conditions", conditions), ("encounters", encounters),
                       ("observations", observations), ("medications", medications)):
        _write(folder, name, rows)
    return str(folder)


def test_stages(spark, sources, tmp_path):
    at = {n: str(tmp_path / n) for n in (
        "cohort", "labels", "features", "train", "model", "calibrator", "metrics", "report", "why")}
    stages.build_cohort(spark, sources, REFERENCE_DATE, at["cohort"])
    index = spark.read.parquet(at["cohort"])
    assert shared_as_of(index) == f"{REFERENCE_DATE} 00:00:00"
    stages.make_labels(spark, sources, at["cohort"], at["labels"])
    stages.rolling_features(spark, sources, at["cohort"], at["features"],
                            hba1c_codes="4548-4, 17856-6", sbp_codes="8480-6", dbp_codes="8462-4")
    features = spark.read.parquet(at["features"])
    assert features.where("hba1c_last is null or n_active_meds_180d <> 1").count() == 0
    stages.merge_training_table(spark, at["features"], at["labels"], at["train"])
    table = spark.read.parquet(at["train"])
    assert table.count() == index.count() > 90
    stages.train_classifier(spark, at["train"], at["model"], maxIter=5, maxDepth=3,
                            minInstancesPerNode=5)
    held_out = f"{at['model']}/validation"
    stages.calibrate_model(spark, held_out, at["calibrator"])
    stages.evaluate_model(spark, at["calibrator"], held_out, at["metrics"])
    halved = str(tmp_path / "halved")
    stages.calibrate_model(spark, held_out, halved, calibration_split=0.5)
    stages.evaluate_model(spark, halved, f"{halved}_rest", str(tmp_path / "halved_metrics"))
    assert 0 < spark.read.parquet(f"{halved}_rest").count() < spark.read.parquet(held_out).count()
    document = read_report(spark, at["metrics"], schemas.METRICS_REPORT).first()
    assert document["metrics"]["auroc_raw"] > 0.9
    assert set(document["confusion_matrices"]) == {"high_sensitivity", "balanced", "high_ppv",
                                                   "conservative"}
    made = {n: str(tmp_path / n) for n in ("history", "decision", "runs", "compared")}
    for _ in range(2):  # a stage that runs again leaves the same tables
        code = stages.monitor(spark, at["train"], held_out, at["metrics"], at["metrics"], at["report"],
                              history=made["history"], batch="june", now="2024-06-30 12:00:00")
        assert code in (0, 1)
        retrain = stages.decide_retraining(spark, at["report"], f"{at['model']}/model", made["decision"],
                                           made["history"], now="2999-01-01 00:00:00")
        stages.log_run(spark, made["runs"], "first", f"{at['model']}/model", at["metrics"], now="2024-06-30 12:00:00")
        stages.compare_logged_runs(spark, made["runs"], made["compared"])
    stored = spark.read.json(at["report"]).first()
    assert {f["feature"] for f in stored["drift_analysis"]["features"]} <= set(defaults.FEATURES)
    assert len(stored["performance_analysis"]["metrics"]) == 3
    history = spark.read.parquet(made["history"])
    assert history.count() == 3 and {str(r["measured_at"]) for r in history.collect()} == {"2024-06-30 12:00:00"}
    decision = spark.read.json(made["decision"]).first()
    assert retrain == 1 and decision["reason"] in ("age", "drift") and len(decision["trends"]) == 3
    assert decision["trends"][0]["recent"][0]["value"] is not None
    run = spark.read.parquet(made["runs"]).collect()
    assert [r["run_id"] for r in run] == ["first"] and run[0]["params"]["n_estimators"] == "5"
    assert spark.read.parquet(made["compared"]).first()["param_max_depth"] == "3"
    assert spark.read.parquet(f"{made['compared']}_entries").where("kind = 'metric'").count() == 6
    stages.explain_high_risk(spark, f"{at['model']}/model", held_out, at["why"])
    why = spark.read.parquet(at["why"])
    risky = spark.read.parquet(held_out).where("prediction_proba >= 0.5").count()
    assert why.count() == risky > 0
    assert why.first()["top_features"][0]["feature"].startswith("hba1c")


def test_landed_sources_give_the_same_without_a_shuffle_of_events(spark, sources, tmp_path, rows):
    at = {n: str(tmp_path / n) for n in ("landed", "cohort", "labels", "features", "plain_labels", "plain_features")}
    stages.land_sources(spark, sources, at["landed"], buckets=3)
    stages.land_sources(spark, sources, at["landed"], buckets=3)  # again, to the same tables
    stages.build_cohort(spark, at["landed"], REFERENCE_DATE, at["cohort"])
    codes = dict(hba1c_codes="4548-4, 17856-6", sbp_codes="8480-6", dbp_codes="8462-4")
    for folder, labels, features in ((at["landed"], "labels", "features"), (sources, "plain_labels", "plain_features")):
        stages.make_labels(spark, folder, at["cohort"], at[labels])
        stages.rolling_features(spark, folder, at["cohort"], at[features], **codes)
    read = spark.read.parquet
    assert rows(read(at["labels"])) == rows(read(at["plain_labels"]))
    def rounded(name):
        doubles = [c for c, kind in read(at[name]).dtypes if kind == "double"]
        return rows(read(at[name]).withColumns({c: F.round(c, 9) for c in doubles}))

    assert rounded("features") == rounded("plain_features")
    for name in stages.EVENTS:  # a session that did not land them
        spark.sql(f"DROP TABLE {tables._landed_name(at['landed'] + '/' + name)}")
        assert stages._events(spark, at["landed"], name).count() == stages._events(spark, sources, name).count()
    landed = stages._events(spark, at["landed"], "observations", *stages._bounds(REFERENCE_DATE, before=60))
    plan = landed.groupBy("patient").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    months = {str(r[0])[:7] for r in landed.select("Date").collect()}
    assert months <= {"2024-05", "2024-06"} and "PartitionFilters: [isnotnull(month" in plan


def test_command_line_takes_the_stages_parameters():
    options = vars(cli.parser().parse_args(
        ["labels", "--input-dir", "in", "--cohort-path", "c", "--output", "o",
         "--prediction-window-days", "30", "--positive-classes", "emergency, inpatient"]
    ))
    assert options["prediction_window_days"] == 30 and options["stage"] == "labels"
    options = vars(cli.parser().parse_args(
        ["evaluate", "--calibrator", "c", "--validation", "v", "--output", "o",
         "--thresholds", "high_ppv=0.45"]
    ))
    assert options["thresholds"] == [("high_ppv", 0.45)]
    options = vars(cli.parser().parse_args(
        ["train", "--dataset", "d", "--output-dir", "o", "--params", "maxIter=20", "stepSize=0.1", "lossType=logistic"]
    ))
    assert dict(options["params"]) == {"maxIter": 20, "stepSize": 0.1, "lossType": "logistic"}
