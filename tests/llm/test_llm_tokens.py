"""Token operators against the tokenizers library."""

import gc
import hashlib
import json
import random
import weakref
import zlib

import numpy as np
import public_tokenizers
import pytest

from cohortflow.llm import piece_arrays, pieces, token_counts, token_files, trie_bpe
from cohortflow.llm.pieces import BYTE_PATTERN, WORD_PATTERN, PieceTable, Splitter, load
from cohortflow.session import ship_package

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PARTS = [
    "a", "b", "é", "ß", " ", "  ", "\n", "\t", "'s", "'ll", "don't", "1", "23", "!", "...", "<|endoftext|>",
    "<|startoftext|>", "日本", "́", "\xa0", "İ", "ſ", "Σ", "\x1c", "\x85", "🙂", "aaaaaaa", "THE", "</w>", "\x00",
    "ﬁ", "Å", "꟎", "　", "\U0010ffff", "thereof", "unter",
]


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(7)
    odd = ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, 25))) for _ in range(1500)]
    words = ["".join(draw.choice("abcdeinthouer") for _ in range(draw.randint(1, 14))) for _ in range(1500)]
    return [*odd, *words, "", " ", "  ", "\n", "x" * 5000, "ab " * 3000, "a b " * 5000 + "\n \n"]


@pytest.fixture(scope="module")
def docs(spark, texts):
    ship_package(spark)
    rows = [(i, t, "kept") for i, t in enumerate(texts)] + [(None, "null id", "x"), (7, None, "x"), (7, None, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").repartition(4)


def test_counts(docs):
    library = load(BYTES)
    for r in token_counts.count_tokens(docs, BYTES, limit=50).collect():
        text = r["text"] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 50), text


def test_ids_and_decoding(spark, docs):
    library = load(WORDS)
    encoded = trie_bpe.encode(docs.select("text"), WORDS)
    for r in trie_bpe.decode(encoded, WORDS).collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == ids, r["text"]
        assert r["decoded"] == library.decode(ids, skip_special_tokens=False)
    for r in trie_bpe.digests(docs, WORDS).collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_files(spark, docs, tmp_path):
    library = load(BYTES)
    found = token_files.write_token_files(docs, f"file://{tmp_path}/files", BYTES, 2, shards=5).collect()
    expected = {}
    for r in docs.collect():
        ids = [*library.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        expected.setdefault(r["doc_id"], []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    found.sort(key=lambda r: r["start"])
    ids = [r["doc_id"] for r in found]
    assert ids == sorted(ids, key=lambda i: -1 if i is None else i)
    assert [r["start"] for r in found] == np.cumsum([0, *(r["n_tokens"] for r in found[:-1])]).tolist()
    for i, rows in expected.items():
        assert sorted(rows) == sorted((r["n_tokens"], r["ids_crc32"]) for r in found if r["doc_id"] == i)
    shards = json.loads((tmp_path / "files/manifest.json").read_text())["shards"]
    assert len(shards) > 1 and not list(tmp_path.glob("files/*.ids.*"))
    again = token_files.read_token_files(spark, f"{tmp_path}/files").collect()
    assert sorted(again, key=lambda r: r["start"]) == found


def test_empty_tables(docs, tmp_path):
    none = docs.where("false")
    assert token_counts.count_tokens(none, BYTES).count() == 0
    assert trie_bpe.digests(none, WORDS).count() == 0
    assert token_files.write_token_files(none, str(tmp_path / "none"), BYTES, 2).count() == 0


def test_a_folder_that_is_not_mounted_is_refused(docs):
    with pytest.raises(ValueError):
        token_files.write_token_files(docs, "hdfs://name/files", BYTES, 2)


def test_a_small_table_gives_the_same_values(texts):
    library = load(BYTES)

    def values(pieces):
        return [len(library.encode(p, add_special_tokens=False).ids) for p in pieces]

    small, large = PieceTable(values, limit=50), PieceTable(values)
    for i in range(0, 900, 100):
        some = texts[i : i + 100]
        assert [sum(r) for r in small.rows(some)] == [sum(r) for r in large.rows(some)] == values(some)


def test_settled_classes_below_u0250():
    """The regular expression splits as the library wherever it is used."""
    for path, pattern, normal in ((BYTES, BYTE_PATTERN, None), (WORDS, WORD_PATTERN, load(WORDS).normalizer.normalize_str)):
        library = load(path)
        splitter = Splitter(library, pattern, normal)
        chars = [chr(c) for c in range(1, 0x250)]
        pieces = [f" a{c}1{c}!{c}x{c}" for c in chars] + [f" {c}" for c in chars]
        for piece, words in zip(pieces, splitter.split(pieces)):
            text = normal(piece) if normal else piece
            assert words == [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]


class Strings:
    def __init__(self, *texts):
        self.ids = {t: i for i, t in enumerate(texts)}


def test_only_a_string_that_cannot_overlap_parts_pieces():
    assert piece_arrays.separator(Strings("<|endoftext|>")) == "<|endoftext|>"
    for unfit in (Strings(), Strings("<a>", "<b>"), Strings("aba"), Strings("aa")):
        assert piece_arrays.separator(unfit) is None


def test_groups_hold_every_word_once_in_order():
    words = ["x" * n for n in (1, 0, 50_000, 29_999, 2, 3)]
    assert piece_arrays.groups(words) == [words[:3], [words[3]], words[4:]]
    assert piece_arrays.groups([]) == []
    assert [w for some in piece_arrays.groups(words * 50) for w in some] == words * 50


def test_worker_keeps_only_what_the_operator_at_hand_uses():
    made = []
    first = pieces.kept_by_worker(lambda name: made.append(name) or PieceTable(len))
    second = pieces.kept_by_worker(lambda name: made.append(name) or PieceTable(len))
    kept, dropped = first("a"), weakref.ref(second("b"))
    pieces.release(keep=first)
    gc.collect()
    assert first("a") is kept and dropped() is None
    second("b")
    assert made == ["a", "b", "b"]


@pytest.mark.parametrize("limit", [0, 40, 1_000_000])
def test_encoder_equals_the_library_whatever_it_remembers(texts, limit):
    import pyarrow as pa

    library = load(BYTES)
    encoder = piece_arrays.Encoder(BYTES, "<u2", limit)
    some = [*texts, None, "tail " * 3, " a", "a ", "a\u2003 b", "word.,; <|endoftext|> x"]
    for i in range(0, len(some), 400):
        part = some[i : i + 400]
        ids, sizes = encoder.encode(pa.array(part, pa.string()), b"\x02\x00")
        expected = [[*library.encode(t or "", add_special_tokens=False).ids, 2] for t in part]
        assert sizes.tolist() == [len(e) for e in expected]
        assert ids.tolist() == [x for e in expected for x in e]
        assert len(encoder.words) <= max(limit, 0) or limit > 40
    assert encoder.encode(pa.array([], pa.string()), b"\x02\x00")[1].tolist() == []


def test_letters_below_u0250_are_those_of_arrow():
    import pyarrow as pa
    import pyarrow.compute as pc

    chars = [chr(c) for c in range(0x250)]
    assert pc.utf8_is_alpha(pa.array(chars)).to_pylist() == [c.isalpha() for c in chars]


@pytest.mark.parametrize("limit", [0, 40, 1_000_000])
def test_coder_equals_the_library_whatever_it_remembers(texts, limit):
    import pyarrow as pa

    library = load(WORDS)
    coder = trie_bpe.WordCoder(WORDS, limit)
    some = [*texts, None, "tail " * 3, " a", "a\u2003 b", "word.,; <|endoftext|> x", "\u0130X \u0130", "STRASSE\u00df.", " ".join(map(chr, range(0x21, 0x250)))]
    for i in range(0, len(some), 400):
        part = some[i : i + 400]
        for text, (ids, tokens) in zip(part, coder.ids_and_tokens(pa.array(part, pa.string())), strict=True):
            expected = library.encode(text or "", add_special_tokens=False).ids
            assert ids.decode() == " ".join(map(str, expected)), text
            assert tokens.decode() == library.decode(expected, skip_special_tokens=False)


def test_lower_case_below_u0250_is_that_of_arrow():
    import pyarrow as pa
    import pyarrow.compute as pc

    chars = [chr(c) for c in range(0x250) if c != 0x130]
    assert pc.utf8_lower(pa.array(chars)).to_pylist() == [c.lower() for c in chars]
