"""Texts as space-led pieces whose tokens do not depend on what stands around them.

No pre-token of the patterns used here runs from a character that is not white space into the
space behind it. So a text may be cut before each such space, every distinct piece be worked out
once, and the values be put together again. A worker keeps the values of a bounded number of
pieces from batch to batch; a full table forgets those that were not used for longest, which costs
time and changes nothing.
"""

from __future__ import annotations

import gc
import json
import os
import re
from collections.abc import Callable
from functools import lru_cache

import regex

#: Marks a piece that opens its text and so has no space before it (no text holds this character).
HEAD = "\udfff"
KNOWN_PIECES = 500_000
#: Longer pieces are worked out again each time.
KNOWN_CHARS = 64

#: Stands between pieces that are split in one text; no piece below U+0250 holds it.
MARK = "\U0010ffff"
FAR = regex.compile(r"[^\x00-\u024F]")
#: The pre-tokens of byte-level BPE.
BYTE_PATTERN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^\s\p{{L}}\p{{N}}{MARK}]+|\s+(?={MARK})|\s+(?!\S)|\s+"
)
#: Those of the tokenizers that drop white space.
WORD_PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^\s\p{{L}}\p{{N}}{MARK}]+"

#: Marks that follow a word; an apostrophe could open a suffix.
TAIL = ".,;:!?)]}\"-*/"

_SPACE_AFTER_WORD = re.compile(r"(?<=\S) ")


def space_after_word(text: str) -> list[str]:
    """A text cut at the spaces behind what is not white space."""
    return _SPACE_AFTER_WORD.split(text)


def raw(piece: str) -> str:
    return piece[1:] if piece.startswith(HEAD) else " " + piece


_kept: list = []


def kept_by_worker(build: Callable):
    """What ``build`` returns stays in a worker from task to task, for the last two arguments."""
    cached = lru_cache(maxsize=2)(build)
    _kept.append(cached)
    return cached


def release(keep=None) -> None:
    """Drops what other operators keep in a worker that goes on with this one."""
    for cached in _kept:
        if cached is not keep:
            cached.cache_clear()


class Generations:
    """A mapping of a bounded number of keys: when ``young`` has half of them it becomes ``old``, and what was
    old and has not been asked for since is forgotten."""

    def __init__(self, limit: int):
        self.limit = limit
        self.young: dict = {}
        self.old: dict = {}

    def revive(self, keys: set) -> list:
        """Brings those of ``keys`` that are old back to ``young``; returns the others."""
        old, young, unknown = self.old, self.young, []
        for k in keys:
            if k in old:
                young[k] = old[k]
            else:
                unknown.append(k)
        return unknown

    def trim(self) -> None:
        if len(self.young) > self.limit // 2:
            self.old, self.young = self.young, {}


class PieceTable:
    """``values`` maps raw pieces to one value each."""

    def __init__(self, values: Callable[[list[str]], list], limit: int = KNOWN_PIECES):
        self.values, self.known = values, Generations(limit)

    def rows(self, texts: list[str]) -> list[list]:
        """The values of the pieces of each text, in order."""
        collects = gc.isenabled()
        gc.disable()  # millions of short-lived lists and no cycles
        try:
            return self._rows(texts)
        finally:
            if collects:
                gc.enable()

    def _rows(self, texts: list[str]) -> list[list]:
        self.known.trim()
        known, cut, missing = self.known.young, [], []
        for text in texts:
            parts = text.split(" ")
            parts[0] = HEAD + parts[0]
            cut.append(parts)
            missing.append([p for p in parts if p not in known])
        new: set[str] = set().union(*missing)
        glued = {p for p in new if not p or p[-1].isspace()}  # a space may not be cut off behind these
        if glued:
            new = set()
            for i, miss in enumerate(missing):
                if not glued.isdisjoint(miss):
                    parts = space_after_word(texts[i])
                    parts[0] = HEAD + parts[0]
                    cut[i] = parts
                    miss = [p for p in parts if p not in known]
                new.update(miss)
        unknown = self.known.revive(new)
        known.update(zip(unknown, self.values([raw(p) for p in unknown])))
        result = [list(map(known.__getitem__, parts)) for parts in cut]
        for p in unknown:  # pieces with white space at their end are looked at anew in every text
            if len(p) > KNOWN_CHARS or not p or p[-1].isspace():
                del known[p]
        return result


def load(path: str):
    """The tokenizer of a file, in one thread, without truncation and padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class Splitter:
    """Pieces to pre-tokens as the library's pre-tokenizer gives them.

    Below U+0250 the classes of characters are settled and a regular expression splits as the
    library does, many pieces in one text; what lies beyond goes through the library, whose
    Unicode tables are its own.
    """

    def __init__(self, tokenizer, pattern: str, normal: Callable[[str], str] | None = None):
        self.tokenizer, self.pattern = tokenizer, regex.compile(pattern + "|" + MARK)
        self.normal = normal
        self.special = Special(tokenizer)
        #: The space before a word, where the pattern keeps it.
        self.lead = " " if self.pattern.findall(" a") == [" a"] else ""
        self.plain = not any(s.rstrip(TAIL).isalpha() or not s.rstrip(TAIL) for s in self.special.ids)

    def _word(self, piece: str) -> list[str] | None:
        """The pre-tokens of a space and letters below U+0250, with or without a tail of marks."""
        if piece[:1] != " " or not (piece.isascii() or not FAR.search(piece)):
            return None
        word = piece[1:].lower() if self.normal else piece[1:]
        if word.isalpha():
            return [self.lead + word]
        body = word.rstrip(TAIL)
        return [self.lead + body, word[len(body) :]] if body.isalpha() else None

    def split(self, pieces: list[str]) -> list[list[str | int]]:
        """The pre-tokens of each piece in order; a special string is its id."""
        out: list[list[str | int] | None] = [self._word(p) for p in pieces] if self.plain else [None] * len(pieces)
        rest = [i for i, found in enumerate(out) if found is None]
        near = [i for i in rest if not FAR.search(pieces[i]) and not self.special.within(pieces[i])]
        text = MARK.join([pieces[i] for i in near])
        if near:
            words = self.pattern.findall(text.lower() if self.normal else text)
            start = 0
            for i, end in zip(near, [*(k for k, w in enumerate(words) if w == MARK), len(words)]):
                out[i] = words[start:end]
                start = end + 1
        for i in set(rest).difference(near):
            out[i] = []
            for k, part in enumerate(self.special.split(pieces[i])):
                if k % 2:
                    out[i].append(self.special.ids[part])
                elif part:
                    part = self.normal(part) if self.normal else part
                    found = self.tokenizer.pre_tokenizer.pre_tokenize_str(part)
                    out[i] += [part[a:b] for _, (a, b) in found]
        return out


class Special:
    """Strings that stand for one id wherever they occur, longest first."""

    def __init__(self, tokenizer):
        added = json.loads(tokenizer.to_str())["added_tokens"]
        odd = [t["content"] for t in added if t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]]
        if odd:
            raise ValueError(f"special strings that take in what is around them: {odd}")
        self.ids = {t["content"]: t["id"] for t in added}
        texts = sorted(self.ids, key=len, reverse=True)
        self.pattern = re.compile("(" + "|".join(map(re.escape, texts)) + ")") if texts else None

    def split(self, piece: str) -> list[str]:
        """Plain parts at even places, special strings at odd ones."""
        return self.pattern.split(piece) if self.pattern else [piece]

    def within(self, piece: str) -> bool:
        return self.pattern is not None and self.pattern.search(piece) is not None
