"""The distributed isotonic fit against pooling in one place."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortflow.functions import isotonic
from cohortflow.operators import calibrate


def pooled(x, y):
    """Level of every distinct x by pooling adjacent violators one after another."""
    at = np.unique(x)
    blocks = []
    for v in at:
        own = y[x == v]
        blocks.append([own.sum(), len(own), [v]])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            t, w, vs = blocks.pop()
            blocks[-1] = [blocks[-1][0] + t, blocks[-1][1] + w, blocks[-1][2] + vs]
    return at, np.array([t / w for t, w, vs in blocks for _ in vs])


def cases():
    rng = np.random.default_rng(11)
    x = rng.random(400).round(3)
    yield "noise", x, (rng.random(400) < 0.4).astype(float)
    yield "useful score", x, (rng.random(400) < x).astype(float)
    yield "falling", x, (rng.random(400) > x).astype(float)
    yield "all equal labels", x, np.ones(400)
    yield "rising already", x, x**2
    yield "real labels", x, np.sin(9 * x) + 0.3 * rng.standard_normal(400)
    yield "steps down between ranges", x, np.where(x < 0.5, 0.5 + x, x - 0.5)
    yield "one hot score", np.where(np.arange(400) < 150, 0.25, x), (rng.random(400) < x).astype(float)


CASES = list(cases())
SETTINGS = [(90, 1024, c) for c in CASES] + [(30, 3, CASES[i]) for i in (1, 5, 6)] + [(1_000_000, 1024, CASES[5])]


@pytest.mark.parametrize("points_per_range,bins,case", SETTINGS, ids=[f"{c[0]}, {n} a range" for n, _, c in SETTINGS])
def test_fit_equals_pooling_in_one_place(spark, monkeypatch, points_per_range, bins, case):
    monkeypatch.setattr(isotonic, "BINS", bins)
    _, x, y = case
    df = spark.createDataFrame(list(zip(x.tolist(), y.tolist())), "p double, y double")
    points = calibrate.fit_isotonic(df, "p", "y", points_per_range).collect()
    at, level = pooled(x, y)
    got = sorted((r["score"], r["calibrated"]) for r in points)
    found = np.interp(at, [p for p, _ in got], [c for _, c in got])
    assert found == pytest.approx(level, abs=1e-9)
    assert np.all(np.diff([c for _, c in got]) >= -1e-12)


def test_missing_values_and_no_rows(spark):
    rows = [(0.1, 0), (None, 1), (float("nan"), 1), (0.4, None), (0.9, 1)]
    df = spark.createDataFrame(rows, "p double, y int")
    points = calibrate.fit_isotonic(df, "p", "y")
    assert sorted(map(tuple, points.collect())) == [(0.1, 0.0), (0.9, 1.0)]
    scored = calibrate.apply_isotonic(points, df, "p", "c")
    assert [r["c"] for r in scored.collect()] == pytest.approx([0, None, None, 0.375, 1])
    none = calibrate.fit_isotonic(df.where("false"), "p", "y")
    assert none.count() == 0
    assert [r["c"] for r in calibrate.apply_isotonic(none, df, "p", "c").collect()] == [None] * 5


@pytest.mark.parametrize("parts", [1, 40])
def test_points_that_are_not_shipped_give_the_same(spark, parts):
    rng = np.random.default_rng(2)
    at = np.unique(rng.random(60).round(2))
    level = np.sort(rng.random(len(at)))
    points = spark.createDataFrame(list(zip(at.tolist(), level.tolist())), "score double, calibrated double")
    asked = [*rng.random(200).round(3).tolist(), *at.tolist(), -1.0, 2.0, 0.3, None, float("nan")] * 2
    df = spark.createDataFrame([(i, v) for i, v in enumerate(asked)], "i int, p double")
    few = {r["i"]: r["c"] for r in isotonic.interpolated(points, df, "p", "c", shipped=0, parts=parts).collect()}
    many = {r["i"]: r["c"] for r in isotonic.interpolated(points, df, "p", "c").collect()}
    assert few.keys() == many.keys() == set(range(len(asked)))
    for i, v in enumerate(asked):
        expected = None if v is None or np.isnan(v) else np.interp(v, at, level)
        assert few[i] == pytest.approx(expected) and many[i] == pytest.approx(expected)

