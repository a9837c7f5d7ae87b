"""Language by cross-parsing: how few phrases of a language's sample spell a text.

For each language, the suffix automaton of a sample of labelled text accepts exactly the strings that
occur in the sample. A text is parsed from left to right into longest matches; the more alike text
and sample, the longer the matches and the fewer the phrases. Phrases times the logarithm of the
sample's length, over the text's length, estimate the cross entropy, which is the normal form that
makes samples of unequal length comparable. The language with the least wins.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from cohortflow.llm.common import hash_fraction, held_out, quoted, spread, texts_in_slices, with_struct
from cohortflow.llm.pieces import kept_by_worker, release
from cohortflow.sources.scratch import settle

#: Documents of each language that a sample is drawn from, and its normalised characters at most.
SAMPLE_DOCS, SAMPLE_CHARS = 300, 40_000
#: Of a longer document, evenly spread stretches of so many characters together are drawn from, or of
#: more where a language has few documents (every document is scored whole).
SAMPLE_DOC_CHARS = 20_000
#: A text is cut into pieces of so many normalised characters, parsed side by side.
PIECE_CHARS = 2_048
#: Letters of a piece that are parsed again, to begin with, for the phrase that runs into it.
HEAD = 128
#: Letters of a sample whose moves are in a table.
DENSE = 96
#: Pieces that are parsed side by side.
LANES = 2_048
#: Phrases per character are sharpened by this before they become shares.
SHARPNESS = 12.0
UNDETERMINED = "und"

_NOT_LETTERS = regex.compile(r"\P{L}+")


def normalised(text: str) -> str:
    """Lower-case letters; whatever stands between them is one space. Empty without letters."""
    return _NOT_LETTERS.sub(" ", text.lower()).strip()


class Automaton:
    """The suffix automaton of a text. Moves by its DENSE most frequent letters are a table, those by rarer ones
    sorted keys, so that a language with thousands of letters takes no more room than others."""

    def __init__(self, text: str, number: np.ndarray, letters: int):
        often = [c for c, _ in Counter(text).most_common()]
        # From numbers shared by all languages to the text's own, 0 for letters it does not have.
        self.local = np.zeros(letters + 1, np.uint16)
        self.local[[number[ord(c)] for c in often]] = np.arange(1, len(often) + 1)
        symbols = self.local[number[np.frombuffer(text.encode("utf-32-le"), np.uint32)]].tolist()
        moves: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in symbols:
            state = len(moves)
            moves.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in moves[p]:
                moves[p][c] = state
                p = link[p]
            if p >= 0:
                q = moves[p][c]
                if length[p] + 1 == length[q]:
                    link[state] = q
                else:
                    copy = len(moves)
                    moves.append(dict(moves[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and moves[p].get(c) == q:
                        moves[p][c] = copy
                        p = link[p]
                    link[q] = link[state] = copy
            last = state
        self.dense, self.letters = min(len(often), DENSE) + 1, len(often) + 1
        # Letter 0 is what the sample does not have; it has no moves.
        table = np.full((len(moves), self.dense), -1, np.int32)
        rare: list[tuple[int, int]] = []
        for state, following in enumerate(moves):
            for c, to in following.items():
                if c < self.dense:
                    table[state, c] = to
                else:
                    rare.append((state * self.letters + c, to))
        self.flat = table.ravel()
        self.keys, self.targets = np.array(sorted(rare), np.int64).reshape(-1, 2).T.copy()
        self.bits = math.log2(max(2, len(symbols)))

    def moved(self, states: np.ndarray, letters: np.ndarray, rare: bool) -> np.ndarray:
        """Where each state's move by a letter leads, -1 if it has none."""
        if not rare:
            return self.flat[states.astype(np.int64) * self.dense + letters]
        common = letters < self.dense
        found = self.flat[states.astype(np.int64) * self.dense + np.where(common, letters, 0)]
        if len(self.keys):
            own = np.flatnonzero(~common)
            keys = states[own].astype(np.int64) * self.letters + letters[own]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            found[own] = np.where(self.keys[at] == keys, self.targets[at], -1)
        return found

    def parsed(self, letters: np.ndarray, going: np.ndarray, state: np.ndarray) -> np.ndarray:
        """Reads a row of letters at a time, a text in each column (the first ``going`` of a row still have
        one), from the given states, which become those at the end. True where a phrase begins."""
        own = self.local[letters]
        rare = (own >= self.dense).any(1)
        begins = np.zeros(own.shape, bool)
        for t in range(len(own)):
            n = going[t]
            here, letter = state[:n], own[t, :n]
            following = self.moved(here, letter, rare[t])
            stuck = np.flatnonzero(following < 0)
            begins[t, :n] = here == 0
            if len(stuck):
                # A new phrase opens with this letter; one that the sample does not have is a phrase alone.
                begins[t, stuck] = True
                again = self.moved(np.zeros(len(stuck), np.int32), letter[stuck], rare[t])
                following[stuck] = np.maximum(again, 0)
            state[:n] = following
        return begins


class Parser:
    """Phrase counts of texts under each language's sample."""

    def __init__(self, samples: tuple[tuple[str, str], ...]):
        self.languages = [lang for lang, _ in samples]
        letters = sorted(set().union(*(set(text) for _, text in samples)))
        self.number = np.zeros(0x110000, np.int32)
        for i, c in enumerate(letters):
            self.number[ord(c)] = i + 1
        self.automata = [Automaton(text, self.number, len(letters)) for _, text in samples]

    def phrases(self, texts: list[str]) -> np.ndarray:
        """A row per normalised text, a column per language: the phrases of the whole text.

        Long texts are cut into pieces that are parsed side by side, each as if a phrase began with it. The parse of
        the whole text goes on with the phrase that is open at a seam; from the first place on where both begin a
        phrase they are the same, which is soon, so only the start of a piece is parsed again.
        """
        owner, pieces = [], []
        for i, text in enumerate(texts):
            for k in range(0, len(text), PIECE_CHARS):
                owner.append(i)
                pieces.append(text[k : k + PIECE_CHARS])
        owner = np.array(owner, np.int64)
        found = np.zeros((len(texts), len(self.automata)), np.int64)
        if not pieces:
            return found
        inner = np.flatnonzero(np.r_[False, owner[1:] == owner[:-1]])  # pieces that go on with a text
        lengths = np.array([len(p) for p in pieces])
        for k, automaton in enumerate(self.automata):
            fresh, heads, ends = self._fresh(automaton, pieces, lengths, inner)
            counts, ended, left = fresh.copy(), ends.copy(), inner
            while len(left):
                own = heads[np.searchsorted(inner, left)]
                again, last = self._resumed(automaton, pieces, lengths, left, ended, fresh[left], own, ends[left])
                changed = left[last != ended[left]]
                counts[left], ended[left] = again, last
                left = np.intersect1d(changed + 1, inner)  # these begin elsewhere now
            np.add.at(found[:, k], owner, counts)
        return found

    def _fresh(self, automaton: Automaton, pieces: list[str], lengths: np.ndarray, inner: np.ndarray):
        """Phrases, the begins of phrases among the first HEAD letters of ``inner`` pieces, and the last state of
        each piece, parsed from its start."""
        counts, ends = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int32)
        heads = np.zeros((len(inner), HEAD), bool)
        place = np.full(len(pieces), -1)
        place[inner] = np.arange(len(inner))
        for some in self._lanes(np.arange(len(pieces)), lengths):
            state = np.zeros(len(some), np.int32)
            begins = automaton.parsed(*self._rows([pieces[i] for i in some]), state)
            counts[some], ends[some] = begins.sum(0), state
            own = np.flatnonzero(place[some] >= 0)
            heads[place[some[own]], : len(begins[:HEAD])] = begins[:HEAD, own].T
        return counts, heads, ends

    def _resumed(self, automaton, pieces, lengths, which, ended, counts, heads, last):
        """Phrases and last states of pieces that go on from where the pieces before them ended, from those
        (``counts``, ``heads``, ``last``) of their own parses."""
        open_ = np.flatnonzero(ended[which - 1] != 0)
        for most in (HEAD, PIECE_CHARS):
            unmet = []
            for some in self._lanes(open_, np.minimum(lengths[which], most)):
                own = which[some]
                state = ended[own - 1].copy()
                begins = automaton.parsed(*self._rows([pieces[i][:most] for i in own]), state)
                if most == HEAD:
                    head = heads[some, : len(begins)].T
                    both = begins & head
                    met = both.any(0)
                    first = both.argmax(0)
                    before = np.arange(len(begins))[:, None] < first
                    counts[some[met]] += ((begins & before).sum(0) - (head & before).sum(0))[met]
                    whole = ~met & (lengths[own] <= HEAD)
                    unmet.append(some[~met & (lengths[own] > HEAD)])
                else:
                    whole = np.ones(len(some), bool)
                counts[some[whole]], last[some[whole]] = begins.sum(0)[whole], state[whole]
            open_ = np.concatenate(unmet) if unmet else open_[:0]
        return counts, last

    def _lanes(self, which: np.ndarray, lengths: np.ndarray) -> Iterator[np.ndarray]:
        """``which`` in order of falling length, LANES at a time."""
        order = which[np.argsort(-lengths[which], kind="stable")]
        for start in range(0, len(order), LANES):
            yield order[start : start + LANES]

    def _rows(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Letters of pieces of falling length, a piece a column, and how many columns have one in each row."""
        lengths = np.array([len(p) for p in pieces])
        held = np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32)
        letters = np.zeros((lengths[0], len(pieces)), np.int32)
        lane = np.repeat(np.arange(len(pieces)), lengths)
        step = np.arange(len(held)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        letters[step, lane] = self.number[held]
        return letters, np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), "right")

    def judge(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """The language, its share of the evidence, its share against the runner-up alone, and the letters of a
        phrase on average, for each text."""
        texts = [normalised(t) for t in texts]
        lengths = np.array([len(t) for t in texts])
        bits = np.array([a.bits for a in self.automata])
        phrases = self.phrases(texts)
        costs = phrases * bits / np.maximum(lengths, 1)[:, None]
        best = costs.argmin(1)
        relative = costs / np.maximum(costs.min(1, keepdims=True), 1e-9)
        shares = np.exp(-SHARPNESS * (relative - 1))
        score = np.where(lengths > 0, 1 / shares.sum(1), 0.0)
        second = np.partition(shares, -2, axis=1)[:, -2] if shares.shape[1] > 1 else np.zeros(len(texts))
        lead = np.where(lengths > 0, 1 / (1 + second), 0.0)
        spelled = lengths / np.maximum(phrases[np.arange(len(texts)), best], 1)
        langs = [self.languages[b] if n else UNDETERMINED for b, n in zip(best.tolist(), lengths.tolist())]
        return langs, score, lead, spelled


def learn(
    docs: DataFrame,
    sample_docs: int = SAMPLE_DOCS,
    sample_chars: int = SAMPLE_CHARS,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> tuple[tuple[str, str], ...]:
    """Samples of the languages of the documents that are not held out: (language, normalised text).

    Of each language, documents with the smallest hashes of their ids, about ``sample_docs``, give
    their whole texts, or evenly spread stretches of long ones, in that order until ``sample_chars``
    are reached; repeated texts count once.
    """
    id_, text, lang = (F.col(quoted(c)) for c in (id_col, text_col, lang_col))
    rows = docs.where(~held_out(id_col)).select(
        lang.cast("string").alias("lang"), text.alias("text"), hash_fraction(id_col, "language").alias("hash")
    ).where("lang is not null and hash is not null")
    counts = rows.groupBy("lang").count()
    # A row per language, written first so that its size is known where the join is planned.
    most = F.greatest(F.lit(SAMPLE_DOC_CHARS), F.ceil(F.lit(2 * sample_chars) / F.col("count"))).cast("int")
    share = (F.lit(float(sample_docs)) / F.col("count")).alias("share")
    share = settle(counts.select("lang", share, most.alias("most")), "languages")
    drawn = rows.join(share, "lang").where((F.col("hash") < F.col("share")) & F.col("text").isNotNull())
    drawn = drawn.withColumn("text", spread(F.col("text"), F.col("most")))
    samples: dict[str, str] = {}
    seen: set[str] = set()
    for row in sorted(drawn.select("lang", "hash", "text").collect(), key=lambda r: (r["lang"], r["hash"])):
        text = normalised(row["text"])
        held = samples.setdefault(row["lang"], "")
        if text and text not in seen and len(held) < sample_chars:
            seen.add(text)
            samples[row["lang"]] = f"{held} {text}"[: len(held) + 1 + sample_chars]
    return tuple((lang, text[:sample_chars]) for lang, text in sorted(samples.items()) if text)


@kept_by_worker
def _parser(samples: tuple[tuple[str, str], ...]) -> Parser:
    return Parser(samples)


def identify(docs: DataFrame, samples: tuple[tuple[str, str], ...], text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (the share of evidence for it, 0 to 1), ``lead`` (its share against the
    runner-up alone; 1 if one language was learned) and ``phrase_chars`` (letters of a phrase under its sample, on
    average; 1 for what no sample has) of every whole text.

    A null text and one without letters are ``und`` with zeros; so is every text where no sample was
    learned. Texts of any length are parsed whole. Ties go to the language that comes first by name. Repeated rows
    each get their result, an empty table gives an empty one, and columns of the four names are replaced.
    """

    @arrow_udf("struct<lang_pred string, score double, lead double, phrase_chars double>")
    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release(keep=_parser)
        parser = _parser(samples) if samples else None
        for column in batches:
            langs, numbers = [], [[np.zeros(0)] for _ in range(3)]
            for texts in texts_in_slices(column):
                found = parser.judge(texts) if parser else ([UNDETERMINED] * len(texts), *[np.zeros(len(texts))] * 3)
                langs += found[0]
                for held, more in zip(numbers, found[1:]):
                    held.append(more)
            yield pa.StructArray.from_arrays(
                [pa.array(langs, pa.string()), *[pa.array(np.concatenate(n), pa.float64()) for n in numbers]], names=names
            )

    names = ["lang_pred", "score", "lead", "phrase_chars"]
    return with_struct(docs, judged(F.col(quoted(text_col))), names)
