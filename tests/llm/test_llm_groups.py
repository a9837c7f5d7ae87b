"""Near duplicates and components against all pairs."""

import random

import numpy as np
import pytest
import xxhash

from cohortflow.llm import embedding_dedup, simhash
from cohortflow.llm.blocks import Forest, grouped_batches
from cohortflow.llm.components import connected_components
from cohortflow.session import ship_package


def parts_of(nodes, links):
    """The smallest node each is linked to."""
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.mark.parametrize(
    "links",
    [
        [],
        [(1, 1)],
        [(i, i + 1) for i in range(200)],  # a chain
        [(500, i) for i in range(300)],  # a star with the largest in the middle
        [(random.Random(i).randrange(400), random.Random(-i).randrange(400)) for i in range(1, 250)],
    ],
)
def test_components(spark, links):
    df = spark.createDataFrame([*links, (None, 3)] if links else [], "a long, b long")
    expected = parts_of({n for e in links for n in e} | ({3} if links else set()), links)
    assert {r["node"]: r["component"] for r in connected_components(df).collect()} == expected


def test_forest_and_whole_groups():
    import pyarrow as pa

    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 90, 70), rng.integers(0, 90, 70)
    forest = Forest(90)
    forest.link(a, b)
    assert forest.roots().tolist() == [parts_of(range(90), zip(a.tolist(), b.tolist()))[n] for n in range(90)]
    keys = np.sort(rng.integers(0, 12, 300))
    for size in (1, 7, 40, 300):
        batches = [
            pa.RecordBatch.from_arrays([pa.array(keys[i : i + size])], names=["k"]) for i in range(0, 300, size)
        ]
        groups = [
            table.column("k")[s:e].to_pylist()
            for table, starts in grouped_batches(iter(batches), ["k"])
            for s, e in zip(starts[:-1].tolist(), starts[1:].tolist())
        ]
        assert [(g[0], len(g)) for g in groups] == [(k, (keys == k).sum()) for k in np.unique(keys)]


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicate_texts(spark):
    draw = random.Random(5)
    words = [f"w{i}é" for i in range(300)]
    texts = []
    for _ in range(40):
        text = [draw.choice(words) for _ in range(draw.randint(1, 150))]
        for _ in range(draw.randint(1, 6)):
            copy = list(text)
            if draw.random() < 0.6:
                copy[draw.randrange(len(copy))] = "Other"
            texts.append(draw.choice([" ", "\n", " \t"]).join(copy))
    texts += ["", None, "  ", "\xa0", "A B", "a b", "x" * 100_000, "y " * 50_000]
    rows = [(i, t, 0) for i, t in enumerate(texts)] + [(None, texts[0], 1), (None, "alone and null", 1), (3, texts[3], 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint int")
    prints = [plain_fingerprint(t or "") for _, t, _ in rows]
    near = [(i, k) for i in range(len(rows)) for k in range(i) if (prints[i] ^ prints[k]).bit_count() <= 4]
    part = parts_of(range(len(rows)), near)
    least = {}
    for i, (doc, _, _) in enumerate(rows):
        least[part[i]] = min((x for x in (least.get(part[i]), doc) if x is not None), default=None)
    expected = [(doc, f"{prints[i]:016x}", least[part[i]]) for i, (doc, _, _) in enumerate(rows)]
    found = [tuple(r) for r in simhash.near_duplicates(df).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    groups = {}
    for i, (doc, text, _) in enumerate(rows):
        groups.setdefault(part[i], []).append(i)
    found = kept.collect()
    assert len(found) == len(groups)  # one of each group, also where ids are null
    assert sorted((r["doc_id"] for r in found), key=repr) == sorted(
        (min((rows[i][0] for i in g if rows[i][0] is not None), default=None) for g in groups.values()), key=repr
    )
    some = spark.createDataFrame([(1, "same text here", 0), (None, "same text here", 0), (None, "same text here", 0), (None, "alone", 1), (None, "alone", 1)], df.schema)
    assert sorted(map(tuple, simhash.drop_near_duplicates(some).collect()), key=repr) == [(1, "same text here", 0), (None, "alone", 1)]
    assert simhash.near_duplicates(df.where("false")).count() == 0


@pytest.mark.parametrize("block_rows", [4096, 5])
def test_near_fingerprints(spark, block_rows):
    rng = np.random.default_rng(1)
    prints = set()
    for base in rng.integers(0, 1 << 63, 20):
        for _ in range(rng.integers(1, 25)):
            value = int(base)
            for bit in rng.choice(64, rng.integers(0, 8), replace=False):
                value ^= 1 << int(bit)
            prints.add(value - (1 << 64) if value >> 63 else value)
    prints = sorted(prints)
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    near = [(a, b) for a in prints for b in prints if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 4]
    found = connected_components(simhash.near_edges(df, 4, block_rows))
    found = {r["node"]: r["component"] for r in found.collect()}
    assert {p: found.get(p, p) for p in prints} == parts_of(prints, near)


def test_repeated_ids_have_the_links_of_their_own_vectors(spark):
    rows = [(1, [1.0, 0.0, 0.0], 0), (1, [0.0, 1.0, 0.0], 0), (2, [1.0, 0.01, 0.0], 0), (1, [0.0, 0.0, 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in embedding_dedup.near_vectors(df).collect())
    assert found == [(1, 0, 1), (1, 0, 1), (1, 1, 1), (2, 1, 1)]


def test_signs_and_tables_follow_from_the_number_of_vectors():
    for n in (0, 1, 500, 5_000, 10**6, 10**9):
        bits, tables = embedding_dedup.plan(n)
        meet = (1 - np.arccos(0.93) / np.pi) ** bits
        assert 1 - (1 - meet) ** tables >= 0.995 > 1 - (1 - meet) ** (tables - 1)
        assert n / 2**bits <= 512 and (bits == embedding_dedup.LEAST_BITS or n / 2**bits > 256)


def test_recall_at_the_least_cosine():
    """Pairs at exactly the least cosine meet as often as the plan says."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((4000, 32))
    y = rng.standard_normal((4000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(1, keepdims=True) * x
    y = 0.93 * x + np.sqrt(1 - 0.93**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    bits, tables = embedding_dedup.plan(100_000)
    signs = [np.packbits(v @ embedding_dedup.planes(32, bits, tables) >= 0, axis=1, bitorder="little") for v in (x, y)]
    a, b = (embedding_dedup.bucket_numbers(s, bits, tables) for s in signs)
    assert (a == b).any(1).mean() > 0.98


@pytest.mark.parametrize("block_rows", [2048, 9])
def test_near_vectors(spark, block_rows):
    rng = np.random.default_rng(2)
    rows = []
    for _ in range(12):
        base = rng.standard_normal(24)
        for _ in range(rng.integers(1, 30)):
            noise = rng.choice([0.0, 0.02, 0.05, 0.08, 0.3])
            vector = (base + noise * rng.standard_normal(24)) * rng.choice([1.0, 1.0, 7.0])
            rows.append((len(rows), vector.astype("float32").tolist(), int(rng.integers(0, 2)), 0))
    rows += [(len(rows) + i, rows[0][1], 0, 0) for i in range(40)]  # copies
    rows += [(5, rows[40][1], 1, 0), (5, rows[90][1], 0, 0), (5, rows[90][1], 0, 0), (77, (-np.array(rows[3][1])).tolist(), 1, 0)]
    n = len(rows)
    odd = [None, [], [0.0] * 24, [float("nan")] * 24, [float("inf")] * 24, [None] * 24, [1.0] * 23]
    rows += [(n + i, v, 0, 0) for i, v in enumerate(odd)]
    rows += [(n + 20, rows[0][1], None, 0), (n + 20, rows[0][1], None, 0), (None, rows[0][1], 0, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, n_links int")
    fit = list(range(n))
    x = np.array([rows[i][1] for i in fit], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = [
        (i, k) for i in fit for k in fit
        if i < k and rows[i][2] == rows[k][2] and x[i] @ x[k] >= 0.93
    ]
    part = parts_of(fit, near)
    least = {}
    for i in fit:
        least[part[i]] = min(least.get(part[i], rows[i][0]), rows[i][0])
    links = np.bincount([i for pair in near for i in pair], minlength=len(rows))
    component = [v if i not in part else least[part[i]] for i, (v, _, _, _) in enumerate(rows)]
    expected = [(v, int(links[i]), component[i], v is None or component[i] == v) for i, (v, _, _, _) in enumerate(rows)]
    found = [tuple(r) for r in embedding_dedup.near_vectors(df, recall=0.999999, block_rows=block_rows, bucket_rows=40).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    assert embedding_dedup.near_vectors(df.where("false")).count() == 0
