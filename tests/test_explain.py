"""Contributions against the definition, and the fitted model end to end."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortflow.functions import trees
from cohortflow.functions.coalitions import Coalitions, contributions
from cohortflow.functions.trees import Forest, Leaf, load_forest
from cohortflow.operators import calibrate, explain, train
from cohortflow.sources import models
from workload import explained, panel
from workload.base import QUERIES

FEATURES = ["a", "b", "c"]


def by_definition(worth, k):
    """Shapley values from all coalitions; ``worth`` maps a set of players to a number."""
    phi = []
    for j in range(k):
        others = [i for i in range(k) if i != j]
        phi.append(sum(
            factorial(len(s)) * factorial(k - len(s) - 1) / factorial(k)
            * (worth(set(s) | {j}) - worth(set(s)))
            for size in range(k) for s in combinations(others, size)
        ))
    return phi


def test_a_fit_over_all_sets_is_the_definition():
    rng = np.random.default_rng(0)
    for k in (1, 2, 3, 5):
        worth = rng.normal(size=1 << k)
        number = lambda s: sum(1 << int(i) for i in s)
        sets = Coalitions.of(k)
        assert len(sets.known) == max(0, 2**k - 2)
        of_sets = np.array([[worth[number(np.flatnonzero(row))] for row in sets.known]])
        phi = sets.solve(of_sets.reshape(1, -1), worth[0], np.array([worth[-1]]))[0]
        assert phi == pytest.approx(by_definition(lambda s: worth[number(s)], k))


def test_thirty_features_and_many_background_rows():
    """Drawn sets find the closed form of a linear score, and add up for any score."""
    rng = np.random.default_rng(1)
    weights, background = rng.normal(size=30), rng.normal(size=(150, 30))
    rows = rng.normal(size=(4, 30))
    sets = Coalitions.of(30, 400, seed=5)
    assert len(sets.known) <= 400 and (sets.known.sum(0) * 2 == len(sets.known)).all()  # complements
    phi = contributions(lambda x: x @ weights, rows, background, sets)
    assert phi == pytest.approx((rows - background.mean(0)) * weights)
    squared = lambda x: (x @ weights) ** 2
    phi = contributions(squared, rows, background, sets)
    assert phi.sum(1) == pytest.approx(squared(rows) - squared(background).mean())


def test_long_paths_by_the_definition_and_deep_trees_add_up():
    rng = np.random.default_rng(2)

    def grow(depth, width, box, share):
        if not depth:
            fs = sorted(box)
            low, high = (np.array([box[f][i] for f in fs]) for i in (0, 1))
            return [Leaf(float(rng.normal()), np.array(fs, int), low, high, np.array([share[f] for f in fs]))]
        f = int(rng.integers(width))
        low, high = box.get(f, (-np.inf, np.inf))
        cut = rng.uniform(max(low, -2), min(high, 2))
        part = rng.uniform(0.0, 1.0) if rng.random() < 0.9 else 0.0  # a branch that no training row took
        found = []
        for bounds, p in (((low, cut), part), ((cut, high), 1 - part)):
            found += grow(depth - 1, width, {**box, f: bounds}, {**share, f: share.get(f, 1.0) * p})
        return found

    forest = Forest(grow(4, 7, {}, {}), 7)
    rows = rng.normal(size=(3, 7))
    for row, phi in zip(rows, forest.contributions(rows)):
        def worth(known):
            return sum(
                leaf.value * np.prod([
                    float(low < row[f] <= high) if f in known else share
                    for f, low, high, share in zip(leaf.features, leaf.low, leaf.high, leaf.share)
                ])
                for leaf in forest.leaves
            )

        assert phi == pytest.approx(by_definition(worth, 7))
    deep = Forest(grow(10, 40, {}, {}) + grow(11, 25, {}, {}), 40)
    rows = rng.normal(size=(60, 40))
    assert deep.base + deep.contributions(rows).sum(1) == pytest.approx(deep.margin(rows))


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(400):
        a, b, c = rng.normal(), float(rng.integers(0, 4)), rng.normal()
        y = int(a + 0.5 * b + rng.normal() * 0.3 > 0.8)
        rows.append((i, float(a), b, None if i % 9 == 0 else float(c), y))
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, label_90d int")
    model = train.fit_classifier(df, FEATURES, maxIter=4, maxDepth=3, minInstancesPerNode=5)
    return df, model, load_forest(spark, model.stages[-1])


def test_scores_keep_ids_and_beat_chance(fitted):
    df, model, _ = fitted
    scored = train.score(model, df, FEATURES)
    assert scored.columns == [*df.columns, "prediction_proba", "prediction"]
    right = scored.where("prediction = label_90d").count()
    assert right > 340


def test_forest_reproduces_the_model(fitted):
    df, model, forest = fitted
    rows = train.assembled(model, df, FEATURES).collect()
    inputs = np.array([r["inputs"] for r in rows])
    assert forest.margin(inputs) == pytest.approx([r["margin"] for r in rows])
    assert forest.probability(inputs) == pytest.approx([r["prediction_proba"] for r in rows])


def test_tree_contributions_match_the_definition(fitted):
    """Absent features follow the training shares down both branches."""
    df, model, forest = fitted
    inputs = np.array([r["inputs"] for r in train.assembled(model, df, FEATURES).limit(5).collect()])
    got = forest.contributions(inputs)
    for row, phi in zip(inputs, got):
        def worth(known):
            total = 0.0
            for leaf in forest.leaves:
                part = leaf.value
                for f, low, high, share in zip(leaf.features, leaf.low, leaf.high, leaf.share):
                    part *= float(low < row[f] <= high) if f in known else share
                total += part
            return total

        assert phi == pytest.approx(by_definition(worth, forest.width))


def test_tree_shap_adds_up(fitted):
    df, model, forest = fitted
    explained = explain.tree_shap(train.assembled(model, df, FEATURES), forest, FEATURES)
    row = explain.shap_additivity(explained).first()
    assert row["n"] == 400 and row["max_error"] < 1e-9 and row["passed"]
    strongest = explain.shap_global(explained, FEATURES, top_k=1).first()["feature"]
    assert strongest == "a"
    assert train.feature_importance(model, FEATURES, df.sparkSession).first()["feature"] == "a"


def test_kernel_shap_matches_the_definition(fitted):
    df, model, forest = fitted
    rows = train.assembled(model, df, FEATURES)
    background = explain.background_sample(rows, ["id"], 7)
    assert len(background) == 7
    found = explain.kernel_shap(rows.where("id < 4"), forest.probability, background, FEATURES, 2)
    for r in found.join(rows.select("id", "inputs"), "id").collect():
        row = np.array(r["inputs"])

        def worth(known):
            mixed = background.copy()
            for j in known:
                mixed[:, [j, j + 3]] = row[[j, j + 3]]
            return forest.probability(mixed).mean()

        phi = [c["phi"] for c in r["contributions"]]
        assert phi == pytest.approx(by_definition(worth, 3))
        assert r["base"] + sum(phi) == pytest.approx(r["prediction_proba"])
    more = explain.kernel_shap(rows.where("id < 2"), forest.probability, np.zeros((101, 6)), FEATURES)
    assert more.count() == 2
    with pytest.raises(ValueError):
        explain.kernel_shap(rows, forest.probability, np.zeros((0, 6)), FEATURES)


def test_mixes_are_scored_without_being_written_out(fitted, monkeypatch):
    """The forest is asked for rows and background rows only, and its mixes have the scores they would have alone."""
    _, _, forest = fitted
    rng = np.random.default_rng(3)
    rows, background = rng.normal(size=(11, 6)), rng.normal(size=(7, 6))
    rows[4, 0] = background[2, 1] = np.nan
    sets = Coalitions.of(3)
    expected = contributions(lambda inputs: forest.probability(inputs), rows, background, sets)
    asked, margin = [], Forest.margin
    monkeypatch.setattr(Forest, "margin", lambda self, inputs: asked.append(len(inputs)) or margin(self, inputs))
    assert contributions(forest.probability, rows, background, sets) == pytest.approx(expected, abs=1e-12)
    assert sum(asked) == len(rows) + len(background)
    monkeypatch.setattr(trees, "MIXED_AT_ONCE", 3)
    monkeypatch.setattr(trees, "LEAVES_AT_ONCE", 2)
    assert contributions(forest.probability, rows, background, sets) == pytest.approx(expected, abs=1e-12)


def test_mixes_with_inputs_that_no_path_asks_for():
    """Features 1 and 3 of four are in no tree, one tree is a single leaf."""
    box = np.array([0.5]), np.array([np.inf]), np.array([0.4])
    rest = np.array([-np.inf]), np.array([0.5]), np.array([0.6])
    leaves = [Leaf(v, np.array([f]), *b) for f in (0, 2, 6) for v, b in ((0.3 + f, box), (-0.8, rest))]
    forest = Forest([*leaves, Leaf(0.25, np.array([], int), *np.zeros((3, 0)))], 8)
    rng = np.random.default_rng(5)
    rows, background, sets = rng.random((9, 8)), rng.random((6, 8)), Coalitions.of(4)
    phi = contributions(forest.probability, rows, background, sets)
    assert phi == pytest.approx(contributions(lambda inputs: forest.probability(inputs), rows, background, sets), abs=1e-12)
    assert phi[:, [1, 3]] == pytest.approx(0, abs=1e-12) and np.abs(phi[:, [0, 2]]).min() > 1e-3
    single = contributions(Forest(leaves[:2], 1).probability, rows[:, :1], background[:, :1], Coalitions.of(1))
    score = Forest(leaves[:2], 1).probability
    assert single[:, 0] == pytest.approx(score(rows[:, :1]) - score(background[:, :1]).mean())


def test_a_deep_model_adds_up(spark, fitted):
    """Paths of more features than sets of them could be listed for."""
    rng = np.random.default_rng(9)
    names = [f"f{i}" for i in range(16)]
    x = rng.normal(size=(3000, 16))
    y = (np.sin(3 * x).sum(1) + rng.normal(size=3000) > 0).astype(int)
    rows = [(i, *map(float, v), int(t)) for i, (v, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id int, " + ", ".join(f"{n} double" for n in names) + ", label_90d int")
    model = train.fit_classifier(df, names, maxIter=2, maxDepth=15, minInstancesPerNode=1)
    forest = load_forest(spark, model.stages[-1])
    assert max(len(leaf.features) for leaf in forest.leaves) > 8
    few = train.assembled(model, df.where("id < 200"), names)
    row = explain.shap_additivity(explain.tree_shap(few, forest, names)).first()
    assert row["n"] == 200 and row["max_error"] < 1e-9 and row["passed"]


def test_dummy_player_gets_nothing():
    background = np.zeros((3, 4))
    phi = contributions(lambda x: x[:, 0] * 2.0, np.array([[1.0, 5.0, 0.0, 0.0]]), background, Coalitions.of(2))
    assert phi[0] == pytest.approx([2.0, 0.0])


def test_model_and_calibrator_round_trip(spark, fitted, tmp_path):
    df, model, _ = fitted
    models.save_model(model, str(tmp_path / "m"))
    loaded = models.load_classifier(str(tmp_path / "m"))
    scored = train.score(loaded, df, FEATURES)
    assert scored.exceptAll(train.score(model, df, FEATURES)).count() == 0
    models.save_calibrator(calibrate.fit_isotonic(scored), str(tmp_path / "c"))
    calibrator = models.load_calibrator(spark, str(tmp_path / "c"))
    both = train.score_calibrated(loaded, calibrator, df, FEATURES)
    bounds = both.agg(F.min("prediction_calibrated"), F.max("prediction_calibrated")).first()
    assert 0 <= bounds[0] <= bounds[1] <= 1
    assert calibrator.count() > 1


@pytest.fixture(scope="module")
def linear(spark):
    df = spark.createDataFrame(
        [("x", 1.0, 10.0, 0.9), ("y", 3.0, None, 0.2), ("z", 2.0, 30.0, 0.5)],
        "patient string, u double, v double, prediction_proba double",
    )
    return explain.linear_shap(df, {"u": 2.0, "v": -0.1}, 0.5)


def test_linear_contributions(linear):
    rows = {r["patient"]: r for r in linear.collect()}
    assert rows["x"]["base"] == pytest.approx(0.5 + 2 * 2 - 0.1 * 20)
    assert [c["phi"] for c in rows["x"]["contributions"]] == pytest.approx([-2.0, 1.0])
    assert [c["phi"] for c in rows["y"]["contributions"]] == pytest.approx([2.0, 0.0])


def test_local_top_and_waterfall(linear):
    top = explain.shap_local_top(linear, ["patient"], 1).where("patient = 'x'").first()
    assert (top["rank"], top["feature"], top["phi"]) == (1, "u", pytest.approx(-2.0))
    steps = explain.waterfall_steps(linear, ["patient"]).where("patient = 'x'").orderBy("step").collect()
    assert [s["feature"] for s in steps] == ["v", "u"]
    assert [s["start"] for s in steps] == pytest.approx([2.5, 3.5])
    assert steps[-1]["stop"] == pytest.approx(1.5)


def test_high_risk_report(linear):
    found = explain.high_risk_explanations(linear, "patient", F.lit("2024-05-06 07:08:09").cast("timestamp"))
    rows = {r["patient"]: r["report"] for r in found.collect()}
    assert set(rows) == {"x", "z"}
    text = rows["x"]
    assert text.startswith("# Why this score\nEntity x, written 2024-05-06 07:08:09\n\n"
                           "- score 0.900 (High)\n- score without any feature 2.500")
    assert "1. u\n   - value 1.00\n   - share -2.000, which decreases the score" in text
    assert "2. v\n" in text and "which increases the score" in text
    assert "(Medium)" in rows["z"]


def test_the_split_is_stored_and_its_rows_are_never_broadcast(spark, tmp_path):
    """Every query on the classifier reads one stored split, and joins of its rows are dealt by key."""
    key = F.col("id")
    kinds = F.array(*map(F.lit, ("view", "signup", "click", "purchase", "error")))
    spark.range(3000).select(
        key.alias("event_id"),
        F.expr("timestamp_ntz'2024-01-01 00:00:07' + make_dt_interval(CAST(id * 7 % 29 AS INT), CAST(id % 24 AS INT))").alias("ts"),
        (key % 40).alias("user_id"),
        kinds[F.pmod(F.xxhash64(key), F.lit(5)).cast("int")].alias("event_type"),
        (F.pmod(F.xxhash64(key, F.lit(1)), F.lit(500)) / 7).alias("value"),
        F.lit("{}").alias("props"),
    ).write.parquet(f"{tmp_path}/events.parquet")

    def plan_of(df):
        return df._jdf.queryExecution().executedPlan().toString()

    joined = plan_of(panel.training_rows(spark, str(tmp_path)))
    assert "BroadcastHashJoin" not in joined and "SortMergeJoin" in joined
    held_out = explained._fitted(spark, str(tmp_path))[1]
    assert held_out.count() > 0
    assert "Join" not in plan_of(held_out)
    for name in ("model_roundtrip", "tree_local_checked", "tree_waterfall_checked"):
        plan = plan_of(QUERIES[name](spark, str(tmp_path)))
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan, name
