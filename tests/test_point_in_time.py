"""Windows around index dates: literal cases, brute force, and agreement of both plans."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cohortflow.functions.scalars import age_on, tolerant_number
from cohortflow.operators import cohort, features, labels, quality, windows
from cohortflow.sources.scratch import settle

OBS = "patient string, Date timestamp, Code string, Description string, Value string"


def at(text):
    return datetime.fromisoformat(text)


@pytest.fixture
def observations(spark):
    return spark.createDataFrame(
        [
            ("patient1", at("2024-01-01"), "4548-4", "Hemoglobin A1c", "7.2"),
            ("patient1", at("2024-01-15"), "8480-6", "Systolic blood pressure", "140"),
            ("patient2", at("2024-01-01"), "4548-4", "Hemoglobin A1c", "6.8"),
            ("patient2", at("2024-01-10"), "17856-6", "Hemoglobin A1c", "7.5"),
        ],
        OBS,
    )


def test_code_and_description_filters(observations):
    assert features.observations_by_code(observations, ["4548-4", "17856-6"]).count() == 3
    assert features.observations_by_code(observations, []).count() == 0
    for term in ("A1c", "a1c"):
        assert features.observations_by_description(observations, term).count() == 3


def test_null_description_does_not_match(spark):
    df = spark.createDataFrame([("A1c",), (None,)], "Description string")
    assert features.observations_by_description(df, "a1c").count() == 1
    assert df.where(~features.selector([], "a1c")).count() == 1


@pytest.mark.parametrize(
    "values, last, mean, std",
    [
        (["1.0", "2.5", "3.2", None, "4.1"], 4.1, 2.7, 1.133578),
        (["1.0", "2.5", "invalid", "4.1"], 4.1, 2.533333, 1.265789),
        (["1.0", "2.5", "invalid"], 2.5, 1.75, 0.75),
        ([], None, None, None),
    ],
)
@pytest.mark.parametrize("shared", [True, False])
def test_last_value_and_stats(spark, values, last, mean, std, shared):
    index = spark.createDataFrame([("p", at("2024-02-01"))], "patient string, as_of timestamp")
    events = spark.createDataFrame(
        [("p", at("2024-01-01") + timedelta(days=i), v) for i, v in enumerate(values)],
        "patient string, Date timestamp, Value string",
    )
    number, every = tolerant_number(F.col("Value")), F.lit(True)
    measures = [windows.Last("last", number, every), windows.Stats("mean", "std", number, every)]
    (row,) = windows.lookback_aggregates(
        index, events, measures, "Date", 180, at="2024-02-01" if shared else None
    ).collect()
    assert row["last"] == last
    for name, expected in (("mean", mean), ("std", std)):
        assert row[name] == (None if expected is None else pytest.approx(expected, abs=1e-6))


def test_constant_values_have_no_spread(spark):
    index = spark.createDataFrame([("p", at("2024-02-01"))], "patient string, as_of timestamp")
    events = spark.createDataFrame(
        [("p", at("2024-01-01") + timedelta(hours=7 * i), 123456789.1) for i in range(90)],
        "patient string, Date timestamp, Value double",
    )
    stats = windows.Stats("mean", "std", F.col("Value"), F.lit(True))
    (row,) = windows.lookback_aggregates(index, events, [stats], "Date", 180).collect()
    assert row["mean"] == pytest.approx(123456789.1)
    assert row["std"] < 1e-6


@pytest.mark.parametrize(
    "text, number",
    [("7.2", 7.2), (" 5 ", 5.0), ("+1e2", 100.0), (".5", 0.5), ("1d", None), ("1.5f", None),
     ("n/a", None), ("", None), (None, None), ("inf", None), ("NaN", None), ("1,5", None)],
)
def test_tolerant_number(spark, text, number):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(tolerant_number(F.col("v"))).first()[0] == number


@pytest.mark.parametrize(
    "born, on, age",
    [("2004-02-29", "2023-02-28", 18), ("2004-02-29", "2023-03-01", 19),
     ("1980-06-30", "1998-06-30", 18), ("1980-07-01", "1998-06-30", 17)],
)
def test_age(spark, born, on, age):
    day = spark.createDataFrame([(born, on)], "b string, o string").select(
        age_on(F.to_date("b"), F.to_date("o"))
    )
    assert day.first()[0] == age


def test_cohort(spark, rows):
    patients = spark.createDataFrame(
        [("a", "1980-01-01"), ("b", "2015-01-01"), ("c", None), ("d", "1970-01-01")],
        "Id string, BirthDate string",
    ).withColumn("BirthDate", F.to_date("BirthDate"))
    conditions = spark.createDataFrame(
        [("a", "44054006"), ("a", "44054006"), ("b", "44054006"), ("c", "44054006"), ("d", "1")],
        "Patient string, Code string",
    )
    found = cohort.build_cohort(patients, conditions, "2024-12-31")
    assert rows(found) == [("a", 44, at("2024-12-31"))]


@pytest.fixture
def leakage(spark):
    index = spark.createDataFrame(
        [("p1", at("2024-06-01")), ("p2", at("2024-06-15")), ("p3", at("2024-07-01"))],
        "patient string, as_of timestamp",
    )
    observations = spark.createDataFrame(
        [("p1", at("2024-05-01")), ("p1", at("2024-06-01")), ("p1", at("2024-06-15")),
         ("p2", at("2024-06-10")), ("p2", at("2024-07-01"))],
        "patient string, Date timestamp",
    )
    encounters = spark.createDataFrame(
        [("p1", at("2024-05-15"), "outpatient"), ("p1", at("2024-06-20"), "Emergency"),
         ("p2", at("2024-06-05"), "outpatient")],
        "patient string, Start timestamp, EncounterClass string",
    )
    return index, observations, encounters


def test_leakage_audit(leakage, rows):
    index, observations, _ = leakage
    audit = quality.leakage_audit(index, observations, "Date", 180)
    assert [r[0:1] + r[2:] for r in rows(audit)] == [
        ("p1", 2, 1, 0), ("p2", 1, 1, 0), ("p3", 0, 0, 0)
    ]


def test_labels(leakage, rows):
    index, _, encounters = leakage
    made = labels.make_labels(index, encounters)
    assert [(r[0], r[2]) for r in rows(made)] == [("p1", 1), ("p2", 0), ("p3", 0)]


def test_label_window_is_open_then_closed(spark, rows):
    day = at("2024-03-01")
    offsets = {"on": timedelta(0), "same_day": timedelta(hours=10), "last": timedelta(days=90),
               "late": timedelta(days=90, microseconds=1)}
    index = spark.createDataFrame([(n, day) for n in offsets], "patient string, as_of timestamp")
    encounters = spark.createDataFrame(
        [(n, day + o, "inpatient") for n, o in offsets.items()],
        "patient string, Start timestamp, EncounterClass string",
    )
    expected = {"on": 0, "same_day": 1, "last": 1, "late": 0}
    for shared in (None, day):
        made = labels.make_labels(index, encounters, at=shared)
        assert {r[0]: r[2] for r in rows(made)} == expected


def test_as_of_off_the_grid_is_exact(spark):
    index = spark.createDataFrame(
        [("p", at("2024-03-01 10:30:00"))], "patient string, as_of timestamp"
    )
    events = spark.createDataFrame(
        [("p", at("2024-03-01 10:00:00")), ("p", at("2024-03-01 11:00:00"))],
        "patient string, Date timestamp",
    )
    count = [windows.Count("n")]
    assert windows.lookback_aggregates(index, events, count, "Date", 1).first()["n"] == 1
    finer = windows.lookback_aggregates(index, events, count, "Date", 1, grain=60_000_000)
    assert finer.first()["n"] == 1


def _random_world(spark, seed, hot=False, clock=None):
    """Entities with events and intervals; one of them holds a third of everything. ``clock`` are
    the times of day that index rows have, midnight unless given."""
    rng = random.Random(seed)
    start = at("2024-01-01")

    def entity():
        return "hot" if hot and rng.random() < 0.34 else f"p{rng.randrange(12)}"

    def moment():
        whole = timedelta(days=rng.randrange(40))
        return start + whole + rng.choice([timedelta(0), timedelta(seconds=rng.randrange(86400))])

    index = sorted({(entity(), start + timedelta(days=rng.randrange(40))) for _ in range(60)})
    if clock:
        index = [(who, day + clock[i % len(clock)]) for i, (who, day) in enumerate(index)]
    events = [
        (entity(), moment(), rng.choice("abc"), rng.choice(["x ray", "A1C test", None]),
         rng.choice(["1.5", "2", "x", None, "7"]), i)
        for i in range(400)
    ]
    intervals = []
    for _ in range(200):
        begin = moment()
        end = rng.choice([None, begin + timedelta(days=rng.randrange(9)), moment()])
        intervals.append((entity(), begin, end, rng.choice(["m1", "m2", "m3", None])))
    return (
        index, events, intervals,
        spark.createDataFrame(index, "patient string, as_of timestamp"),
        spark.createDataFrame(
            events,
            "patient string, Date timestamp, Code string, Description string, Value string, id int",
        ),
        spark.createDataFrame(
            intervals, "patient string, Start timestamp, Stop timestamp, Description string"
        ),
    )


def _expected(index, events, intervals, lookback):
    result = {}
    for who, day in index:
        low = day - timedelta(days=lookback)
        seen = [e for e in events if e[0] == who and low <= e[1] <= day]
        numbers = {"1.5": 1.5, "2": 2.0, "7": 7.0}
        picked = sorted(
            ((e[1], e[5], numbers[e[4]]) for e in seen if e[2] == "a" and e[4] in numbers)
        )
        values = [p[2] for p in picked]
        mean = sum(values) / len(values) if values else None
        std = (sum((v - mean) ** 2 for v in values) / len(values)) ** 0.5 if values else None
        active = {
            m[3] for m in intervals
            if m[0] == who and m[3] and m[1] <= day and (m[2] is None or m[2] >= low)
        }
        result[(who, day)] = (
            len(seen), len(active), values[-1] if values else None, mean, std
        )
    return result


def _computed(index, events, intervals, lookback, shared=None):
    found = features.rolling_features(
        index, events, events.withColumnRenamed("Date", "Start"), intervals,
        lookback, "a", "b", "c", ties=["id"], at=shared,
    )
    return {
        (r["patient"], r["as_of"]): (
            r["n_observations_180d"], r["n_active_meds_180d"], r["hba1c_last"],
            r["hba1c_mean"], r["hba1c_std"],
        )
        for r in found.collect()
    }


@pytest.mark.parametrize("hot", [False, True])
def test_features_match_brute_force(spark, hot):
    index, events, intervals, *frames = _random_world(spark, 7, hot)
    expected, got = _expected(index, events, intervals, 5), _computed(*frames, 5)
    assert got.keys() == expected.keys()
    for key, values in expected.items():
        assert got[key] == pytest.approx(values), key


CLOCKS = {
    "half past": [timedelta(hours=10, minutes=30)],
    "mixed": [timedelta(0), timedelta(hours=10, minutes=30), timedelta(seconds=40_000, microseconds=7)],
}


def _with_events_at_the_ends(spark, world, days_back):
    """The world and further events at, just before and just after the ends of windows."""
    index, events, intervals, index_frame, event_frame, interval_frame = world
    tick = timedelta(microseconds=1)
    more = [
        (who, moment + offset + nudge, "a", "x ray", "2", 1000 + i)
        for i, (who, moment) in enumerate(index[:20])
        for offset in (timedelta(0), -timedelta(days=days_back), timedelta(days=days_back))
        for nudge in (-tick, timedelta(0), tick)
    ]
    frame = event_frame.union(spark.createDataFrame(more, event_frame.schema))
    return index, events + more, intervals, index_frame, frame, interval_frame


@pytest.mark.parametrize("clock", sorted(CLOCKS))
def test_features_off_the_grid_match_brute_force(spark, clock):
    world = _random_world(spark, 17, True, CLOCKS[clock])
    index, events, intervals, *frames = _with_events_at_the_ends(spark, world, 5)
    expected, got = _expected(index, events, intervals, 5), _computed(*frames, 5)
    assert got.keys() == expected.keys()
    for key, values in expected.items():
        assert got[key] == pytest.approx(values), key


@pytest.mark.parametrize("clock", sorted(CLOCKS))
def test_counts_and_labels_off_the_grid_match_brute_force(spark, clock):
    world = _random_world(spark, 19, True, CLOCKS[clock])
    index, events, _, frame, event_frame, _ = _with_events_at_the_ends(spark, world, 3)
    one, three = timedelta(days=1), timedelta(days=3)
    own = {key: [e[1] - key[1] for e in events if e[0] == key[0]] for key in index}

    found = windows.count_horizons(frame, event_frame, "Date", [1, 3], "n").collect()
    assert {(r["patient"], r["as_of"]): (r["n_1d"], r["n_3d"]) for r in found} == {
        k: tuple(sum(-h <= s <= timedelta(0) for s in since) for h in (one, three))
        for k, since in own.items()
    }
    audit = quality.leakage_audit(frame, event_frame, "Date", 3).collect()
    assert {tuple(r[:2]): tuple(r[2:]) for r in audit} == {
        k: (
            sum(-three <= s <= timedelta(0) for s in since),
            sum(s > timedelta(0) for s in since),
            sum(s < -three for s in since),
        )
        for k, since in own.items()
    }
    visits = event_frame.withColumnsRenamed({"Date": "Start", "Code": "EncounterClass"})
    made = labels.make_labels(frame, visits, 3, ["a"]).collect()
    hits = {
        (e[0], k[1]) for e in events for k in index
        if e[0] == k[0] and e[2] == "a" and timedelta(0) < e[1] - k[1] <= three
    }
    assert {tuple(r[:2]): r[2] for r in made} == {k: int(k in hits) for k in index}


def test_both_plans_agree(spark):
    index, events, intervals, _, event_frame, interval_frame = _random_world(spark, 3, True)
    day = at("2024-01-20")
    people = spark.createDataFrame(
        sorted({(who, day) for who, _ in index}), "patient string, as_of timestamp"
    )
    shared = _computed(people, event_frame, interval_frame, 6, shared=day)
    own = _computed(people, event_frame, interval_frame, 6)
    assert shared.keys() == own.keys()
    for key, values in own.items():
        assert shared[key] == pytest.approx(values)


def test_features_ignore_the_future(spark):
    index, events, intervals, frame, event_frame, interval_frame = _random_world(spark, 5)
    before = _computed(frame, event_frame, interval_frame, 5)
    last = max(day for _, day in index)
    later = spark.createDataFrame(
        [(who, last + timedelta(seconds=1), "a", "A1C test", "9", 9999) for who, _ in index],
        event_frame.schema,
    )
    after = _computed(frame, event_frame.union(later), interval_frame, 5)
    assert before.keys() == after.keys()
    assert all(after[k] == pytest.approx(v) for k, v in before.items())


def test_result_does_not_depend_on_partitioning(spark):
    _, _, _, frame, event_frame, interval_frame = _random_world(spark, 11, True)
    once = _computed(frame, event_frame.coalesce(1), interval_frame, 4)
    shuffled = event_frame.orderBy(F.rand(1)).repartition(7)
    again = _computed(frame.repartition(3), shuffled, interval_frame.repartition(5), 4)
    assert all(again[k] == pytest.approx(v) for k, v in once.items())


def test_repeated_index_rows_each_get_features(spark):
    day = at("2024-01-10")
    index = spark.createDataFrame([("p", day), ("p", day)], "patient string, as_of timestamp")
    events = spark.createDataFrame([("p", day)], "patient string, Date timestamp")
    found = windows.lookback_aggregates(index, events, [windows.Count("n")], "Date", 3)
    assert [r["n"] for r in found.collect()] == [1, 1]


def test_horizons_and_future_join(spark, rows):
    index, events, _, frame, event_frame, _ = _random_world(spark, 13, True)
    found = windows.count_horizons(frame, event_frame, "Date", [1, 5], "n")
    for r in found.collect():
        for h in (1, 5):
            low = r["as_of"] - timedelta(days=h)
            expected = sum(
                e[0] == r["patient"] and low <= e[1] <= r["as_of"] for e in events
            )
            assert r[f"n_{h}d"] == expected
    joined = windows.future_window_join(frame, event_frame, "Date", 3).select("patient", "as_of", "id")
    expected = sorted(
        ((w, day, e[5]) for w, day in index for e in events
         if e[0] == w and day < e[1] <= day + timedelta(days=3)), key=repr
    )
    assert rows(joined) == expected


def test_clinical_bands(spark, rows):
    df = spark.createDataFrame(
        [(5.6, 119.0, 79.0), (5.7, 120.0, 80.0), (6.5, 130.0, 90.0), (None, 140.0, None)],
        "hba1c_last double, sbp_last double, dbp_last double",
    )
    found = features.clinical_bands(df).select("hba1c_band", "sbp_band", "dbp_band")
    assert set(rows(found)) == {
        ("normal", "normal", "normal"), ("prediabetic", "elevated", "elevated"),
        ("diabetic", "stage1", "high"), (None, "high", None),
    }


@pytest.mark.parametrize("first,last", [(-360, 0), (-2, 0), (0, 0), (1, 64), (-17, 5), (-1, 0)])
def test_blocks_make_up_the_window(spark, first, last):
    """Every cell of a window lies in exactly one of its blocks, and blocks are few."""
    moments = [datetime(2024, 1, 1) + timedelta(hours=h) for h in (0, 24, 24 * 31, 24 * 77, 12, 12 + 24 * 40)]
    index = spark.createDataFrame([("p", m) for m in moments * 2], "patient string, as_of timestamp")
    blocks = windows.window_blocks(index, "patient", "as_of", first, last)
    cells = {}
    for r in blocks.collect():
        own = cells.setdefault(r["as_of"], [])
        own += range(r["_block"] * r["_size"], (r["_block"] + 1) * r["_size"])
    sizes = windows.block_sizes(first, last)
    for r in index.distinct().select("as_of", windows.time_cell(F.col("as_of")).alias("at")).collect():
        off = r["at"] % 2
        opens = r["at"] + first + (off if first % 2 == 0 else 0)
        assert sorted(cells.get(r["as_of"], [])) == list(range(opens, r["at"] + last - off + 1))
    counts = {r["as_of"]: r["count"] for r in blocks.groupBy("as_of").count().collect()}
    assert all(n <= 2 * (windows.RADIX - 1) * (len(sizes) + 1) for n in counts.values())


@pytest.fixture
def stored_days(spark):
    """A stored index of some days per patient, and events of the same patients."""
    day = F.expr("timestamp_ntz'2024-01-08 00:00:00' + make_dt_interval(d)")
    days = spark.range(40).select(F.col("id").alias("patient"), F.explode(F.sequence(F.lit(0), F.lit(20))).alias("d"))
    index = settle(days.select("patient", day.alias("as_of")), "index")
    moved = settle(index.select("patient", (F.col("as_of") + F.expr("INTERVAL 5 HOUR")).alias("as_of")), "index")
    at = F.expr("timestamp_ntz'2024-01-05 00:00:01' + make_dt_interval(CAST(id % 20 AS INT))")
    events = spark.range(400).select(
        (F.col("id") % 40).alias("patient"), at.alias("Date"), at.alias("Start"), at.alias("Stop"), F.lit("a").alias("Code"),
        F.lit("a").alias("EncounterClass"), F.lit("a").alias("Description"), F.lit("1").alias("Value"), "id",
    )
    return {"on": index, "off": moved}, settle(events, "events")


@pytest.mark.parametrize("grid", ["on", "off"])
def test_index_is_never_broadcast_by_the_size_of_its_file(stored_days, grid):
    index, events = stored_days[0][grid], stored_days[1]
    found = features.rolling_features(index, events, events, events, 7, ["a"], ["a"], ["a"], ties=["id"])
    for df in (found, labels.make_labels(index, events, 1, ["a"])):
        assert df.count() == 40 * 21
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan, grid
