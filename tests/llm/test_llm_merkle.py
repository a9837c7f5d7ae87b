"""The manifest against hashes taken one after another."""

import hashlib
import zlib

import pytest

from cohortflow.llm import merkle
from cohortflow.session import ship_package

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, rank int, tree string, digest string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row):
    doc, text, lang, source, n = row
    return h(*map(field, (doc, source, lang, n, text)))


def grown(level):
    """All levels over some digests, up to the one of a single node."""
    levels = [level]
    while len(level) > 1:
        level = [h(*level[i : i + 8]) for i in range(0, len(level), 8)]
        levels.append(level)
    return levels


def climb(levels, place, digest):
    """Siblings from the bottom up, and the top that ``digest`` at ``place`` leads to."""
    siblings = []
    for level in levels[:-1]:
        run = level[place // 8 * 8 : place // 8 * 8 + 8]
        siblings += run[: place % 8] + run[place % 8 + 1 :]
        digest = h(*run[: place % 8], digest, *run[place % 8 + 1 :])
        place //= 8
    return siblings, digest


def plain(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[lang] = own, grown([leaf_of(r) for r in own])
    top = grown([trees[lang][1][-1][0] for lang in langs])
    out = []
    for k, lang in enumerate(langs):
        own, levels = trees[lang]
        for place, r in enumerate(own):
            changed = list(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None:
                changed[1] = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1])
            siblings, digest = climb(levels, place, leaf_of(changed))
            more, folded = climb(top, k, digest)
            root = top[-1][0]
            out.append((r[0], leaf_of(r), levels[-1][0], root, h(*siblings, *more), folded, folded == root))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", 1, "b", "c") for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows():
    texts = ["Plain Text", "no capitals", "", None, "ÄÖ Straße İ", "A" * 70_000, "two\nlines\tTab", "日本 X"]
    out = [(i * 7 % 1000, texts[i % 8], ["en", "de", "EN", "ζ"][i * i % 4], f"s{i % 3}", i) for i in range(590)]
    out += [(i, "One", None, None, None) for i in range(9)] + [(None, "No Id", "en", "s", 1), (None, "No Id", "en", "s", 1), (None, None, None, None, None)]
    out += [(5, "Again", "de", "s", 1)] * 70 + [(5, "Other", "de", "s", 1), (41, "ALONE", "xx", "s", 2)]
    return out + [(1000 + i, "Short", f"l{i}", "s", 0) for i in range(70)]


def test_manifest(spark, rows):
    ship_package(spark)
    found = merkle.verify(frame(spark, rows))
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted(map(tuple, found.collect()), key=repr)
    assert got == sorted(plain(rows), key=repr)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 2, 8, 9, 64, 65])
def test_sizes_around_full_runs(spark, n):
    rows = [(i, f"Text {i}", "en", "s", 6) for i in range(n)]
    got = sorted(map(tuple, merkle.verify(frame(spark, rows) if n else frame(spark, [(1, "", "", "", 0)]).where("false")).collect()))
    assert got == sorted(plain(rows) if n else [])


def test_requests_for_some_leaves(spark, rows):
    found = merkle.manifest(frame(spark, rows))
    wanted = [0, 5, 41, 1003, 700]
    some = merkle.proofs(found, spark.createDataFrame([(i,) for i in wanted], "doc_id long"))
    some = some.withColumn("root", merkle.folded(some["leaf"], some["path"])).select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(some["path"]))
    expected = [r[:5] for r in plain(rows) if r[0] in wanted]
    assert {r["root"] for r in some.collect()} == {found.root}
    assert sorted(map(tuple, some.collect())) == sorted(expected)


def test_records_are_addressed_by_their_content(spark, rows):
    found = merkle.manifest(frame(spark, rows))
    for records in [*found.heights, *found.top]:
        for r in records.collect():
            assert r["digest"] == h(*r["children"]) and 1 <= len(r["children"]) <= 8
