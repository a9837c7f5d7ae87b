"""Byte-pair encoding by a walk over a trie of words, and decoding.

For byte-pair encoding, the last token of a prefix of a word fixes the prefix's encoding: it is the
encoding of what stands before that token, then the token. A token may follow another one exactly if
no merge ever reaches across the seam between the two. So distinct words go into a trie, a
depth-first walk finds the last token of every node from those of the nodes above it, and words that
share a prefix share the work for it.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from tokenizers.pre_tokenizers import ByteLevel

from cohortflow.llm.common import quoted, with_struct
from cohortflow.llm.piece_arrays import PieceColumns, slices
from cohortflow.llm.pieces import WORD_PATTERN, Splitter, kept_by_worker, load, release

KNOWN_SEAMS = 500_000
#: Words of one trie.
TRIE_WORDS = 10_000
#: Words whose ids and tokens a worker keeps, beside the vocabulary and its automaton.
CODED_WORDS = 250_000
NEVER = 1 << 60


class TrieEncoder:
    """Encodes words given in the characters that stand for bytes."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        self.suffix = suffix
        self.tokens = vocab
        self.rank = {(vocab[a], vocab[b]): r for r, (a, b) in enumerate(merges)}
        self.halves = {vocab[a + b]: (vocab[a], vocab[b]) for a, b in merges}
        self.seams: dict[tuple[int, int], bool] = {}
        self.stable: dict[int, bool] = {}
        self.edges: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self._grow()

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """What stands at the left (0) or right (1) edge of a token while it is being built: the
        symbols from the smallest on, each with the rank of the merge that takes it in."""
        found = self.edges.get((token, side))
        if found is None:
            found, merged_at = [], NEVER
            part = token
            while True:
                found.append((part, merged_at))
                if part not in self.halves:
                    break
                halves = self.halves[part]
                merged_at, part = self.rank[halves], halves[side]
            found.reverse()
            self.edges[token, side] = found
        return found

    def _may_follow(self, left: int, right: int) -> bool:
        """Whether the seam between two tokens stays open through all merges."""
        known = self.seams.get((left, right))
        if known is None:
            a, b = self._edge(left, 1), self._edge(right, 0)
            i = j = 0
            known = True
            while True:
                (x, x_until), (y, y_until) = a[i], b[j]
                across = self.rank.get((x, y), NEVER)
                # Of equal ranks the leftmost goes first: before the seam, the seam, behind it.
                if across < x_until and across <= y_until and across < NEVER:
                    known = False
                    break
                if x_until == y_until == NEVER:
                    break
                if x_until <= y_until:
                    i += 1
                else:
                    j += 1
            if len(self.seams) >= KNOWN_SEAMS:
                self.seams.clear()
            self.seams[left, right] = known
        return known

    def _is_stable(self, token: int) -> bool:
        """Whether the merges turn a token's own characters into that token."""
        known = self.stable.get(token)
        if known is None:
            if token not in self.halves:
                known = True
            else:
                left, right = self.halves[token]
                known = self._is_stable(left) and self._is_stable(right) and self._joins(left, right)
            self.stable[token] = known
        return known

    def _joins(self, left: int, right: int) -> bool:
        """Whether the first merge across the seam of two tokens is the one of both as a whole."""
        a, b = self._edge(left, 1), self._edge(right, 0)
        i = j = 0
        while True:
            (x, x_until), (y, y_until) = a[i], b[j]
            if x_until == y_until == NEVER:
                return True
            across = self.rank.get((x, y), NEVER)
            if across < x_until and across <= y_until and across < NEVER:
                return False
            if x_until <= y_until:
                i += 1
            else:
                j += 1

    def _grow(self) -> None:
        """An automaton over the tokens' symbols that names the tokens any path ends with."""
        self.goto: list[dict[str, int]] = [{}]
        self.own: list[int | None] = [None]
        self.depth = [0]
        base: dict[int, tuple[str, ...]] = {}
        text = {i: t for t, i in self.tokens.items()}
        for token in sorted(text):
            if token not in self.halves:
                base[token] = (text[token],)
        for halves in sorted(self.rank, key=self.rank.__getitem__):
            token = self.tokens[text[halves[0]] + text[halves[1]]]
            base.setdefault(token, base[halves[0]] + base[halves[1]])
        for token, symbols in base.items():
            state = 0
            for c in symbols:
                following = self.goto[state].get(c)
                if following is None:
                    following = self.goto[state][c] = len(self.goto)
                    self.goto.append({})
                    self.own.append(None)
                    self.depth.append(self.depth[state] + 1)
                state = following
            self.own[state] = token
        self.fail = [0] * len(self.goto)
        self.ends: list[tuple[tuple[int, int], ...]] = [()] * len(self.goto)
        order = [0]
        for state in order:
            for c, following in self.goto[state].items():
                order.append(following)
                back = self.fail[state]
                while state and back and c not in self.goto[back]:
                    back = self.fail[back]
                self.fail[following] = self.goto[back].get(c, 0) if state else 0
                token, shorter = self.own[following], self.ends[self.fail[following]]
                if token is not None and self._is_stable(token):
                    shorter = ((token, self.depth[following]), *shorter)
                self.ends[following] = shorter

    def _step(self, state: int, symbol: str) -> int:
        while symbol not in self.goto[state]:
            if not state:
                return 0
            state = self.fail[state]
        return self.goto[state][symbol]

    def encode(self, words: list[str]) -> list[list[int]]:
        """The token ids of each word; words without characters have none."""
        root: dict = {}
        for k, word in enumerate(words):
            if not word:
                continue
            node = root
            for c in word[:-1]:
                below = node.get(c)
                if below is None:
                    below = node[c] = {}
                node = below
            node.setdefault((word[-1],), []).append(k)
        out: list[list[int]] = [[] for _ in words]
        # On the way down: the last token of each prefix, and how many characters it takes.
        last: list[int] = []
        back: list[int] = []
        states = [0]
        walks = [iter(root.items())]
        while walks:
            step = next(walks[-1], None)
            if step is None:
                walks.pop()
                states.pop()
                if last:
                    last.pop()
                    back.pop()
                continue
            key, below = step
            ended = key.__class__ is tuple
            state = self._step(states[-1], key[0] + self.suffix if ended else key)
            depth = len(last) + 1
            for token, taken in self.ends[state]:
                if taken == depth or self._may_follow(last[depth - taken - 1], token):
                    break
            else:
                raise ValueError(f"no token ends with {key!r}")
            if ended:
                ids, depth = [token], depth - taken
                while depth:
                    ids.append(last[depth - 1])
                    depth -= back[depth - 1]
                ids.reverse()
                for k in below:
                    out[k] = ids
            else:
                last.append(token)
                back.append(taken)
                states.append(state)
                walks.append(iter(below.items()))
        return out


class WordCoder(PieceColumns):
    """Texts to ids and back, as the library does it with the tokenizer's file."""

    columns = 2

    def __init__(self, path: str, limit: int = CODED_WORDS):
        self.tokenizer = load(path)
        model = json.loads(self.tokenizer.to_str())["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.encoder = TrieEncoder(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        super().__init__(Splitter(self.tokenizer, WORD_PATTERN, self.tokenizer.normalizer.normalize_str), limit)
        self.strings = {i: t for t, i in model["vocab"].items()}
        self.strings |= {i: t for t, i in self.splitter.special.ids.items()}
        # The characters that stand for the bytes, from the library's own pre-tokenizer.
        self.shown: dict[str, str] = {}
        self.byte_level = ByteLevel(add_prefix_space=False, use_regex=False)

    def _as_bytes(self, word: str) -> str:
        return "".join([self.shown.get(c) or self._show(c) for c in word])

    def _show(self, char: str) -> str:
        found = "".join([w for w, _ in self.byte_level.pre_tokenize_str(char)])
        self.shown[char] = found
        return found

    def worked_out(self, words: list[str]) -> list[list[bytes]]:
        """Of each word the ids and the tokens as text, a space behind each. Words are taken in order, so that those
        that share a prefix share a trie, and some thousand at a time, which bounds the trie."""
        shown = [self._as_bytes(w) for w in words]
        order = sorted(range(len(words)), key=shown.__getitem__)
        found: list[list[bytes]] = [[b""] * len(words), [b""] * len(words)]
        for i in range(0, len(order), TRIE_WORDS):
            some = order[i : i + TRIE_WORDS]
            for k, ids in zip(some, self.encoder.encode([shown[k] for k in some])):
                found[0][k], found[1][k] = self._value(ids)
        return found

    def of_special(self, number: int) -> list[bytes]:
        return self._value([number])

    def _value(self, ids: list[int]) -> list[bytes]:
        return ["".join([f"{i} " for i in ids]).encode(), "".join([f"{self.strings[i]} " for i in ids]).encode()]

    def ids_and_tokens(self, texts: pa.Array) -> Iterator[tuple[bytes, bytes]]:
        """Of each text the ids and the tokens, joined by one space."""
        (ids, at), (tokens, to) = self.of_texts(texts)
        ids, tokens = ids.tobytes(), tokens.tobytes()
        for a, b, c, d in zip(at[:-1].tolist(), at[1:].tolist(), to[:-1].tolist(), to[1:].tolist()):
            yield ids[a : max(a, b - 1)], tokens[c : max(c, d - 1)]

    def decode(self, ids) -> str:
        """Tokens joined by a space, as a tokenizer without a decoder does; special ones stay."""
        return " ".join([self.strings[i] for i in ids if i in self.strings])


@kept_by_worker
def _coder(path: str) -> WordCoder:
    return WordCoder(path)


def _check(path: str) -> None:
    whole = json.loads(load(path).to_str())
    steps = whole["pre_tokenizer"].get("pretokenizers", [])
    if whole["decoder"] is not None or not any(s["type"] == "Split" and s["behavior"] == "Removed" for s in steps):
        raise ValueError("for tokenizers that drop white space and have no decoder")


def encode(docs: DataFrame, tokenizer_path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the token ids of every whole text in an array column.

    Ids equal those of the tokenizers library without added special tokens. A null or empty text
    has an empty array; repeated rows each get theirs; an empty table gives an empty one; a column
    named ``ids_col`` is replaced.
    """
    _check(tokenizer_path)

    @arrow_udf("struct<ids array<int>>")
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release(keep=_coder)
        coder = _coder(tokenizer_path)
        for column in batches:
            offsets, flat = [0], []
            for texts in slices(column):
                for text, _ in coder.ids_and_tokens(texts):
                    ids = np.array(text.split(), np.int32)
                    flat.append(ids)
                    offsets.append(offsets[-1] + len(ids))
            ids = np.concatenate(flat) if flat else np.zeros(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.StructArray.from_arrays([lists], names=["ids"])

    held = with_struct(docs, encoded(F.col(quoted(text_col))), ["ids"]) if ids_col == "ids" else None
    return held if held is not None else with_struct(
        docs, F.struct(encoded(F.col(quoted(text_col))).getField("ids").alias(ids_col)), [ids_col]
    )


def decode(df: DataFrame, tokenizer_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with the text of an array of ids: their tokens joined by a space, special ones
    included, ids outside the vocabulary left out. Null and empty arrays give an empty text."""
    _check(tokenizer_path)

    @arrow_udf("string")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release(keep=_coder)
        coder = _coder(tokenizer_path)
        for column in batches:
            yield pa.array([coder.decode(ids or ()) for ids in column.to_pylist()], pa.string())

    return with_struct(df, F.struct(decoded(F.col(quoted(ids_col))).alias(text_col)), [text_col])


def digests(docs: DataFrame, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with n_tokens, ids_sha256 (of the decimal ids joined by one space) and
    decoded_sha256 (of the decoded text in UTF-8), encoded and decoded in one pass.

    A null or empty text has no tokens and the digests of an empty string, a text of any length is encoded whole,
    and columns of the three names are replaced; otherwise as ``encode``.
    """
    _check(tokenizer_path)
    names = ["n_tokens", "ids_sha256", "decoded_sha256"]

    @arrow_udf("struct<n_tokens long, ids_sha256 string, decoded_sha256 string>")
    def digested(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release(keep=_coder)
        coder = _coder(tokenizer_path)
        for column in batches:
            n, ids, decoded = [], [], []
            for texts in slices(column):
                for own, tokens in coder.ids_and_tokens(texts):
                    n.append(own.count(b" ") + 1 if own else 0)
                    ids.append(hashlib.sha256(own).hexdigest())
                    decoded.append(hashlib.sha256(tokens).hexdigest())
            yield pa.StructArray.from_arrays(
                [pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], names=names
            )

    return with_struct(docs, digested(F.col(quoted(text_col))), names)
