"""Quality, language, sketches, licenses and mixing on small tables."""

import hashlib
import itertools

import duckdb
import numpy as np
import pandas as pd
import pytest
import xxhash

from cohortflow.llm import language, licenses, mixing, quality, scaled_sketch
from cohortflow.llm.queries import QUERIES
from cohortflow.session import ship_package

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def test_marginals_equal_sums_over_all_labellings():
    rng = np.random.default_rng(0)
    logits, stay = rng.normal(0, 2, 9), 0.7
    starts = np.array([0, 5, 6])
    good, same = quality._chain(logits, stay, starts)
    for a, b in zip(starts, [5, 6, 9]):
        paths = list(itertools.product((0, 1), repeat=int(b - a)))
        weight = np.array([
            np.exp(sum(l * y for l, y in zip(logits[a:b], p)) + stay * sum(x == y for x, y in zip(p, p[1:]))) for p in paths
        ])
        weight /= weight.sum()
        for i in range(b - a):
            assert good[a + i] == pytest.approx(sum(w for w, p in zip(weight, paths) if p[i]))
            if i:
                assert same[a + i] == pytest.approx(sum(w for w, p in zip(weight, paths) if p[i] == p[i - 1]))


def test_quality(spark):
    clean, junk = "The river is long and the town lies near it.\n" * 3, "BUY NOW!!! $$$ | BUY NOW!!! $$$\n" * 4
    field = quality.fit_field([(quality.line_features(t)[0], y) for t, y in [(clean, 1), (junk, 0)] * 5])
    rows = [(1, clean, 9), (2, junk, 9), (3, "", 9), (4, None, 9), (None, clean, 9), (1, clean, 9), (5, " \n\t", 9), (6, clean + junk * 50, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, Score int")
    found = quality.score(df, field)
    assert found.columns == ["doc_id", "text", "score", "predicted"]
    found = sorted([(r["doc_id"] or 0, r["score"], r["predicted"]) for r in found.collect()])
    by_id = {i: (s, p) for i, s, p in found}
    assert len(found) == len(rows) and all(0 <= s <= 1 and p == (s >= 0.7) for _, s, p in found)
    assert by_id[1][1] == 1 and by_id[0] == by_id[1] and by_id[2][1] == 0 and by_id[6][1] == 0
    assert by_id[3] == by_id[4] == by_id[5] == (0.0, 0)
    assert quality.score(df.where("false"), field).count() == 0
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.score(df, quality.learn(df, empty)).count() == len(rows)


def test_held_out_quality(spark):
    scored = QUERIES["op1_quality_crf"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = scored.where("held_out").join(labels, "doc_id").select("predicted", "quality").toPandas()
    assert len(rows) > 500
    assert (rows.predicted == rows.quality).mean() > 0.97


def phrases(text, sample):
    n = i = 0
    while i < len(text):
        k = i + 1
        while k < len(text) and text[i : k + 1] in sample:
            k += 1
        n, i = n + 1, k
    return n


def test_phrases_are_longest_matches():
    samples = (("x", "abracadabra abba"), ("y", "mississippi miss"))
    parser = language.Parser(samples)
    texts = ["abba miss", "zzz", "a", "", "cadabramississippiq abracadabra", "ba" * 3000]
    expected = [[phrases(t, s) for _, s in samples] for t in texts]
    assert parser.phrases(texts).tolist() == expected


@pytest.mark.parametrize("piece,head", [(2048, 128), (50, 7), (9, 4), (5, 3)])
def test_seams_do_not_change_the_parse(monkeypatch, piece, head):
    monkeypatch.setattr(language, "PIECE_CHARS", piece)
    monkeypatch.setattr(language, "HEAD", head)
    rng = np.random.default_rng(3)
    word = lambda letters, n: "".join(rng.choice(list(letters), n))
    samples = (("x", word("abc ", 900)), ("y", word("ab", 300) + "q" * 60), ("z", "abcabcabc"))
    texts = [word("abcq ", int(n)) for n in (0, 1, 49, 50, 51, 700, 6000)] + ["abc" * 3000, "ab" * 2500 + "q" * 900]
    assert language.Parser(samples).phrases(texts).tolist() == [[phrases(t, s) for _, s in samples] for t in texts]


def test_a_language_of_thousands_of_letters():
    rng = np.random.default_rng(5)
    letters = [chr(0x4E00 + i) for i in range(3000)]
    weight = 1 / np.arange(1, 3001)
    text = "".join(rng.choice(letters, 40_000, p=weight / weight.sum()))
    samples = (("zh", text), ("en", "the dog and the cat go into the house"))
    parser = language.Parser(samples)
    size = sum(a.nbytes for a in (parser.automata[0].flat, parser.automata[0].keys, parser.automata[0].targets))
    assert size < 50_000_000
    texts = [text[500:900] + letters[7] * 5, "the cat", "".join(rng.choice(letters, 3000))]
    assert parser.phrases(texts).tolist() == [[phrases(t, s) for _, s in samples] for t in texts]


@pytest.mark.parametrize("languages", [1, 2, 3, 4, 8])
def test_what_was_not_learned_shows(languages):
    rng = np.random.default_rng(1)
    samples = []
    for i in range(languages):
        words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 9))) for _ in range(300)]
        samples.append((f"l{i}", " ".join(rng.choice(words, 4000))))
    parser = language.Parser(tuple(samples))
    own = [" ".join(s.split()[40:70]) for _, s in samples]
    langs, _, lead, spelled = parser.judge(own)
    assert langs == [lang for lang, _ in samples] and min(spelled) > 4 and min(lead) > 0.9
    langs, _, lead, spelled = parser.judge(["это другой язык", "日本語の文章"])
    assert max(spelled) < 1.5


def test_language(spark):
    samples = (("de", language.normalised("Der Hund und die Katze gehen in das Haus")), ("en", "the dog and the cat go into the house"))
    rows = [(1, "The cat and the dog!"), (2, "Die Katze und der Hund"), (3, None), (4, ""), (5, "123 !!"), (1, "The cat and the dog!"), (6, "the cat " * 4000)]
    df = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, lang_pred string")
    found = {(r["doc_id"], r["lang_pred"], r["score"] > 0.5) for r in language.identify(df, samples).collect()}
    assert found == {(1, "en", True), (2, "de", True), (3, "und", False), (4, "und", False), (5, "und", False), (6, "en", True)}
    assert language.identify(df, samples).count() == len(rows)
    assert language.identify(df.where("false"), samples).count() == 0
    assert {r["lang_pred"] for r in language.identify(df, ()).collect()} == {"und"}
    null = df.withColumn("lang", df.lang_pred).where("lang is null")
    assert language.learn(null) == ()


def test_long_documents_are_learned_from(spark):
    de, en = "der Hund und die Katze gehen in das Haus ", "the dog and the cat go into the house "
    rows = [(i, f"{de}{i} " * 3, "de") for i in range(40)] + [(100 + i, f"{en}{i} " * 900, "en") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert min(len(t) for _, t, lang in rows if lang == "en") > language.SAMPLE_DOC_CHARS
    samples = language.learn(docs)
    assert [lang for lang, _ in samples] == ["de", "en"] and len(samples[1][1]) > 15_000
    found = {r["lang"]: r["lang_pred"] for r in language.identify(docs, samples).collect()}
    assert found == {"de": "de", "en": "en"}
    clean, junk = "The river is long and the town lies near it.\n", "BUY NOW!!! $$$ | BUY NOW!!! $$$\n"
    rows = [(i, clean * (3 + i), 1) for i in range(40)] + [(100 + i, junk * 900, 0) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    field = quality.learn(docs, docs)
    found = quality.score(docs, field).collect()
    assert all(r["predicted"] == r["quality"] for r in found)


def test_stretches_are_spread_evenly(spark):
    text = "".join(chr(0x4E00 + i) for i in range(5000))
    df = spark.createDataFrame([(text,), (text[:100],), ("",)], "text string")
    from cohortflow.llm.common import spread

    whole, short, empty = (r[0] for r in df.select(spread(df.text, 100)).collect())
    parts = whole.split("\n")
    assert [len(p) for p in parts] == [10] * 10 and parts[0] == text[:10] and parts[-1] == text[-10:]
    assert all(p in text for p in parts) and short == text[:100] and empty == ""


def test_held_out_language(spark):
    found = QUERIES["op3_language_id"](spark, "/root/testdata/sf0.01").where("held_out")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = found.join(docs, "doc_id").toPandas()
    assert (rows.lang_pred == rows.lang).mean() > 0.98


def test_edited_pairs(spark):
    texts = ["", None, "a", "ab", "héllo wörld 日本 🙂 end", "one two three four five six seven", "x" * 200_000, "w " * 30_000]
    words = [" ".join(f"w{(i * k) % 97}" for i in range(200)) for k in (1, 2, 3)]
    rows = [(i * 3, t) for i, t in enumerate(texts + words)] + [(6, "ab"), (None, "null id")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_chars int")
    found = scaled_sketch.edited_pairs(df).collect()
    # Ids descend, null last; rows that share an id descend by the hash of their text.
    signed = lambda t: int.from_bytes(xxhash.xxh64_digest(t.encode(), 42), "big", signed=True)
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, signed(r[1])), reverse=True)
    expected, unchanged = [], set()
    for (doc, text), (_, following) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        expected.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest()))
        if edited == text:
            unchanged.add(expected[-1])
    got = [(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    for key, r in zip(got, found):
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert key not in unchanged or (r["near_edited"] == 1 and r["fingerprint"] == r["edited_fingerprint"])
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[0]["fingerprint"] == by_id[3]["fingerprint"]  # empty and null
    assert by_id[24]["fingerprint"] != by_id[27]["fingerprint"]
    assert scaled_sketch.edited_pairs(df.where("false")).count() == 0
    single = scaled_sketch.edited_pairs(df.where("doc_id = 24")).first()
    assert single["near_next"] == 1


def test_sketch_keeps_what_is_below_the_threshold(spark):
    text = " ".join(f"w{i % 700}" for i in range(2000))
    df = spark.createDataFrame([(text,)], "text string")
    import pyspark.sql.functions as F

    row = df.select(
        scaled_sketch.shingle_hashes(F.col("text")).alias("all"), scaled_sketch.sketch(F.col("text")).alias("kept")
    ).first()
    assert len(row["all"]) == 1996
    assert row["kept"] == sorted({h for h in row["all"] if h < -(1 << 63) + (1 << 61)})
    assert 40 < len(row["kept"]) < 140  # an eighth of 700


def test_edited_pairs_of_short_texts_are_exact(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 40, n)) for n in [1, 2, 3, *range(4, 31)] * 2]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def shingles(text):
        words = text.split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    def likeness(a, b):
        x, y = shingles(a), shingles(b)
        return 1.0 if a == b else len(x & y) / min(len(x), len(y)) if x and y else 0.0

    found = {r["doc_id"]: r for r in scaled_sketch.edited_pairs(df).collect()}
    for i, text in enumerate(texts):
        following = texts[(i - 1) % len(texts)]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert found[i]["near_edited"] == pytest.approx(likeness(text, edited))
        assert found[i]["near_next"] == pytest.approx(likeness(text, following))
        assert len(found[i]["fingerprint"]) == 17 + 16 * len(shingles(text))
    assert sum(0 < r["near_edited"] < 1 for r in found.values()) > 20


def test_licenses(spark):
    notice = licenses.TEMPLATES["mit-permission"]
    rows = [
        (1, "Some words here. Released under the MIT License. And more words follow."),
        (2, "released UNDER the mit license"),
        (3, "Released under a MIT License of a kind"),
        (4, None), (5, ""), (6, "word " * 40_000 + notice + " word" * 40_000),
        (7, "x " + notice.replace("obtaining", "getting")), (8, " ".join(notice.split()[:10])),
        (None, "Licensed under CC BY-NC 4.0."), (1, "Some words here. Released under the MIT License. And more words follow."),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, template int")
    found = sorted([(r["doc_id"] or 0, r["template"]) for r in licenses.scan(df).collect()])
    assert found == [
        (0, "cc-by-nc-4.0-line"), (1, "mit-line"), (1, "mit-line"), (2, "mit-line"), (6, "mit-permission"), (7, "mit-permission"),
    ]
    assert licenses.scan(df.where("false")).count() == 0


def duck(documents, sql):
    connection = duckdb.connect()
    connection.register("documents", documents)
    return connection.execute(sql).df()


def same(spark_df, expected):
    columns = sorted(expected.columns)
    assert sorted(spark_df.columns) == columns
    got = sorted((tuple(r[c] for c in columns) for r in spark_df.collect()), key=repr)
    want = [tuple(None if pd.isna(v) else v for v in row) for row in expected[columns].itertuples(index=False)]
    assert [tuple(map(str, r)) for r in got] == [tuple(map(str, r)) for r in sorted(want, key=repr)]


def test_license_sql(spark):
    documents = pd.read_parquet(f"{SF}/documents.parquet")
    same(QUERIES["op8_license_scan"](spark, SF), duck(documents, licenses.notices_sql()))


def notices_by_brute_force(text, templates):
    """Template, containment and regions, from every shingle of the text."""
    import re

    split = lambda t: re.findall("[a-z0-9]+", t.lower())
    out, w = [], split(text or "")
    for name, notice in templates.items():
        own = split(notice)
        k = min(5, len(own))
        wanted = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)}
        cut = [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]
        parts = [len(wanted & set(cut[i : i + 3 * len(wanted)])) / len(wanted) for i in range(len(cut))]
        enough = [i for i, p in enumerate(parts) if p >= 0.8 and cut[i] in wanted]
        assert bool(enough) == any(p >= 0.8 for p in parts)
        if enough:
            regions = sum(j == 0 or enough[j] - enough[j - 1] >= 3 * len(wanted) for j in range(len(enough)))
            out.append((name, round(max(parts), 9), regions))
    return out


def test_notices_wherever_they_stand(spark):
    words = licenses.TEMPLATES["mit-permission"].split()
    texts = [None, "", "Released under the MIT License."]
    for put in (0, 4, 8, 12, 20, 30):
        for offset in range(26):
            inside = words[:15] + [f"x{i}" for i in range(put)] + words[15:]
            texts.append(" ".join([f"a{i}" for i in range(offset)] + inside + ["end"] * 60))
    texts.append(" ".join(words + ["between"] * 200 + words))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {}
    for r in licenses.scan(df).collect():
        found.setdefault(r["doc_id"], []).append((r["template"], round(r["containment"], 9), r["regions"]))
    for i, text in enumerate(texts):
        assert sorted(found.get(i, [])) == sorted(notices_by_brute_force(text, licenses.NOTICES))
    assert all(found[i][0][0] == "mit-permission" for i in range(3, len(texts)))
    assert found[len(texts) - 1] == [("mit-permission", 1.0, 2)]
    for retrieve in (licenses.scan, licenses.notices):
        same(retrieve(df), duck(df.toPandas(), licenses.notices_sql()))
        assert retrieve(df.where("false")).count() == 0


def test_short_notices(spark):
    texts = [
        "All rights reserved.", "© 2020 A. All  RIGHTS reserved! and more", "all rights", "SPDX-License-Identifier: MIT",
        "// SPDX-License-Identifier: Apache-2.0 //", "word " * 2000 + "All rights reserved. " + "word " * 2000, "rights reserved all", "", None,
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = sorted((r["doc_id"], r["template"], r["containment"], r["regions"]) for r in licenses.scan(df).collect())
    assert found == [
        (0, "all-rights-reserved", 1.0, 1), (1, "all-rights-reserved", 1.0, 1), (3, "spdx-mit", 1.0, 1),
        (4, "spdx-apache-2.0", 1.0, 1), (5, "all-rights-reserved", 1.0, 1),
    ]
    for i, text in enumerate(texts):
        assert [f[1:] for f in found if f[0] == i] == notices_by_brute_force(text, licenses.NOTICES)


def test_scattered_shingles_are_retrieved_by_the_bands(spark):
    """Recall where a template's shingles stand alone between foreign ones: of its 22 at least 18 must be found."""
    words = licenses.TEMPLATES["mit-permission"].split()
    cut = [words[i : i + 5] for i in range(len(words) - 4)]
    texts = []
    for k in range(60):
        chosen = cut[: 18 + k % 5]
        texts.append(" ".join(" ".join([*c, *([f"z{k}{i}"] * (1 + k % 2))]) for i, c in enumerate(chosen)))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    key = lambda r: (r["doc_id"], r["template"], r["containment"], r["regions"])
    exact, banded = (sorted(map(key, f(df).collect())) for f in (licenses.notices, licenses.scan))
    assert banded == exact


def test_notices_sql(spark):
    documents = pd.read_parquet(f"{SF}/documents.parquet")
    same(QUERIES["op8_license_notices"](spark, SF), duck(documents, licenses.notices_sql()))


@pytest.mark.parametrize("case", ["given", "hot", "one", "tiny", "long", "empty"])
def test_mixing_sql(spark, case):
    words = lambda n: " ".join(["w"] * n)
    rows = {
        "given": None,
        "hot": [(i, words(1 + i % 7), "a" if i % 3 else f"s{i % 4}") for i in range(300)],
        "one": [(1, words(5), None), (2, None, None), (3, "", None)],
        "tiny": [(i, words(n), s) for i, (n, s) in enumerate([(1, "é"), (100, "z"), (1000, "a"), (3, None), (2, None), (0, "b")])],
        "long": [(1, words(200_000), "a"), (2, words(10), "a"), (3, words(5), "b"), (3, words(7), "b")],
        "empty": [],
    }[case]
    if rows is None:
        df = spark.read.parquet(f"{SF}/documents.parquet")
        documents = pd.read_parquet(f"{SF}/documents.parquet")
    else:
        df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, size int")
        documents = pd.DataFrame(rows, columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64", "text": object, "source": object})
    found = mixing.mix(df)
    if case == "empty":
        assert found.count() == 0
        return
    same(found, duck(documents, mixing.SQL))
    got = found.toPandas()
    assert (got.taken <= 3 * got["size"]).all()
    assert got.taken.sum() == mixing.mixed(df.where("text is not null and doc_id is not null")).select(
        mixing.n_words(df["text"]).alias("n")
    ).groupBy().sum("n").first()[0]


def test_mixed_rows(spark):
    rows = [(i, "w " * (1 + i % 5), "ab"[i % 2], "x") for i in range(40)] + [(None, "a b", "a", "x"), (99, None, "a", "x"), (5, "w w", "a", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, col string")
    out = mixing.mixed(df)
    assert out.columns == df.columns
    assert out.where("doc_id is null").count() == 1 and out.where("doc_id = 99").count() == 1
