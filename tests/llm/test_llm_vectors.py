"""Centroid clustering and exact search against plain loops over all rows."""

import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest

from cohortflow.llm import clustering, top_k
from cohortflow.session import ship_package

SCHEMA = "vec_id long, embedding array<float>, cluster string, x int, score string"
NAN, INF = float("nan"), float("inf")


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def odd_rows(dim):
    """Vectors that take no part, or hardly any."""
    odd = [None, [NAN] + [0.5] * (dim - 1), [INF] * dim, [None] + [0.1] * (dim - 1), [None] * dim]
    return [(9_000 + 100 * i, v) for i, v in enumerate(odd)]


def drawn(n, dim, seed=3, groups=7):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, dim))
    return [(i, (centres[rng.integers(groups)] + 0.3 * rng.standard_normal(dim)).astype("float32").tolist()) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "c", 1, "s") for i, v in rows], SCHEMA).repartition(3)


def finite(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def plain_clusters(rows, k, rounds, scale, seed, dim):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dim and finite(v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    places = [x for _, x in order[:k]]
    for step in range(rounds + 1):
        far = [[sum((a - b) ** 2 for a, b in zip(x, c)) for c in places] for _, x in kept]
        near = [d.index(min(d)) for d in far]
        if step < rounds:
            for c in range(len(places)):
                own = [x for (_, x), n in zip(kept, near) if n == c]
                if own:
                    places[c] = [math.floor(Fraction(sum(col), len(own))) for col in zip(*own)]
    distance = [d[n] for d, n in zip(far, near)]
    of = [sum(d for d, n in zip(distance, near) if n == c) for c in range(len(places))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in places]
    return [(i, n, d, of[n], sum(distance), digest[n]) for (i, _), n, d in zip(kept, near, distance)]


@pytest.mark.parametrize("n,k,rounds", [(400, 16, 3), (60, 5, 6), (9, 16, 3), (1, 16, 1), (40, 4, 0)])
def test_clusters(spark, n, k, rounds):
    rows = drawn(n, 12)
    rows += [(rows[0][0], rows[0][1]), (None, rows[-1][1]), (3, [0.25] * 12), (3, [0.25] * 12), (77, [0.0] * 11), (78, [])] * (n > 1)
    rows += odd_rows(12)
    found = clustering.cluster(frame(spark, rows), centroids=k, rounds=rounds, dimensions=12)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    expected = plain_clusters(rows, k, rounds, 64, 1, 12)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


def test_many_equal_vectors_leave_clusters_empty(spark):
    rows = [(i, [0.5] * 8) for i in range(60)] + drawn(5, 8)
    found = clustering.cluster(frame(spark, rows), centroids=6, dimensions=8)
    expected = plain_clusters(rows, 6, 3, 64, 1, 8)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)


def test_nothing_to_cluster(spark):
    for rows in ([], odd_rows(12)):
        found = clustering.cluster(frame(spark, rows) if rows else frame(spark, drawn(1, 12)).where("false"), dimensions=12)
        assert found.count() == 0 and found.schema["distance"].dataType.simpleString() == "bigint"


def test_components_that_would_leave_64_bits_are_refused(spark):
    with pytest.raises(Exception, match="too large"):
        clustering.cluster(frame(spark, [(1, [3e8] * 4), (2, [0.0] * 4)]), dimensions=4).collect()


def test_products_follow_moved_centroids():
    """What is kept per vector equals products worked out afresh, whatever the centroids do."""
    import pyarrow as pa

    rng = np.random.default_rng(0)
    x = rng.integers(-90, 90, (50, 6))
    assert (clustering.matrix(clustering.lists(x), 6) == x).all()
    assert clustering.lists(x)[7].as_py() == x[7].tolist() and isinstance(clustering.lists(x), pa.ListArray)


def plain_best(rows, best, every, scale):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if i is not None and finite(v)]
    out = []
    for a, (q, v) in enumerate(kept):
        if q % every == 0:
            others = [(-sum(s * t for s, t in zip(v, w)), i) for b, (i, w) in enumerate(kept) if b != a and len(w) == len(v)]
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(others)[:best], 1)]
    return out


@pytest.mark.parametrize(
    "shard_rows,block_queries,every", [(65_536, 16_384, 5), (60, 16_384, 3), (45, 11, 4), (20, 7, 1)]
)
def test_best(spark, monkeypatch, shard_rows, block_queries, every):
    monkeypatch.setattr(top_k, "SMALL_SHARD", 50)
    rows = drawn(300, 10)
    rows += [(400 + i, rows[20][1]) for i in range(60)]  # copies under other ids
    rows += [(20, rows[20][1])] * 14 + [(40, rows[3][1])]  # repeated rows, a repeated id
    rows += [(None, rows[20][1]), (60, []), (65, []), (70, [0.5] * 9), (75, [0.0] * 10), *odd_rows(10)]
    found = top_k.top_k(frame(spark, rows), every=every, shard_rows=shard_rows, block_queries=block_queries)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect())) == sorted(plain_best(rows, 10, every, 1024))


def test_best_of_few_and_none(spark):
    few = [(0, [0.5, -0.25]), (100, [1.0, 2.0]), (7, [-1.0, 0.0])]
    assert sorted(map(tuple, top_k.top_k(frame(spark, few)).collect())) == sorted(plain_best(few, 10, 100, 1024))
    assert top_k.top_k(frame(spark, few).where("false")).count() == 0
    assert top_k.top_k(frame(spark, few).where("vec_id = 7")).count() == 0
    assert top_k.top_k(frame(spark, few[:1])).count() == 0


@pytest.mark.parametrize("large", [1e3, 2.0**40])
def test_scores_stay_exact_beyond_doubles(spark, large):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.integers(-999_999, 999_999, 3) * (large / 1e6)).tolist()) for i in range(40)]
    schema = "vec_id long, embedding array<double>, cluster string, x int, score string"
    df = spark.createDataFrame([(i, v, "c", 1, "s") for i, v in rows], schema)
    if large > 1e6:
        with pytest.raises(Exception, match="64 bits"):
            top_k.top_k(df, every=4, scale=1024).collect()
    else:
        assert sorted(map(tuple, top_k.top_k(df, every=4, scale=1 << 20).collect())) == sorted(plain_best(rows, 10, 4, 1 << 20))


def test_a_tree_leaves_out_what_cannot_be_best():
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((40, 16)) * 900
    x = np.floor(centres[np.arange(8000) % 40] + rng.standard_normal((8000, 16)) * 20)
    ids = rng.permutation(8000)
    tree = top_k.Tree.of(x, ids, np.ones(8000, np.int64))
    seen = []
    merged = tree._merged
    tree._merged = lambda q, names, row, node, *rest: seen.append(len(node)) or merged(q, names, row, node, *rest)
    q = x[:50]
    low, high = np.full(50, np.iinfo(np.int64).min), np.full(50, np.iinfo(np.int64).max)
    row, found, score = tree.search(q, np.full(50, -1), low, high, 10)
    scores = q @ x.T
    for i in range(50):
        order = np.lexsort((ids, -scores[i]))[:10]
        assert found[row == i].tolist() == ids[order].tolist()
        assert score[row == i].tolist() == scores[i][order].tolist()
    assert sum(seen) < 0.3 * 50 * (len(tree.first) + 1) // 2  # leaves visited
    least = np.sort(scores, axis=1)[:, -10].astype(np.int64)  # the k-th best is known from elsewhere
    seen.clear()
    tree.search(q, np.full(50, -1), least, high, 10)
    assert sum(seen) < 0.2 * 50 * (len(tree.first) + 1) // 2
