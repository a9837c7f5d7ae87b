"""What whole texts become word by word, column-wise: pieces, words and values stay in Arrow arrays.

Texts are cut before spaces as in ``pieces``; every distinct piece of a batch is a word with or without a
tail of marks, or is split by the library's rules. Distinct words are looked up among those known from
earlier batches, and only new ones are worked out. A text's value is that of its words, joined.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from cohortflow.llm.pieces import BYTE_PATTERN, KNOWN_CHARS, TAIL, Special, Splitter, load, space_after_word

#: Words whose values a worker keeps.
KNOWN_WORDS = 1_000_000
ENCODED_CHARS = 30_000
#: Bytes of text that are worked out together.
SLICE_BYTES = 2_000_000

#: White space before a space: such texts are not cut at every space.
_GLUED = "[\t\n\v\f\r\x1c-\x1f \u0085\\p{Z}] "
#: Beyond the letters whose class, and lower case of one character, are settled.
_FAR = "[^\\x00-\\x{24F}]|İ"
_LETTERS = "".join(c for c in map(chr, range(0x250)) if c.isalpha())


def _text(value: str) -> pa.Scalar:
    return pa.scalar(value, pa.large_string())


def separator(special: Special) -> str | None:
    """A special string that parts what stands before it from what follows, wherever it is put; the
    library encodes many words in one text faster than each on its own. None if there are several
    special strings, which could overlap, or if the only one can overlap itself."""
    if len(special.ids) != 1:
        return None
    (text,) = special.ids
    return None if any(text.startswith(text[k:]) for k in range(1, len(text))) else text


def groups(words: list[str]) -> list[list[str]]:
    """The words in order, some thousand characters at a time."""
    found, some, held = [], [], 0
    for w in words:
        some.append(w)
        held += len(w) + 1
        if held >= ENCODED_CHARS:
            found.append(some)
            some, held = [], 0
    return found + [some] if some else found


def slices(column: pa.Array) -> list[pa.Array]:
    """A column of texts some million bytes at a time."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    turn = np.cumsum(sizes) // SLICE_BYTES
    cuts = np.r_[0, np.flatnonzero(np.diff(turn)) + 1, len(column)].tolist()
    return [column.slice(a, b - a) for a, b in zip(cuts[:-1], cuts[1:]) if b > a]


class PieceColumns:
    """Texts to one or several columns of bytes, each the values of a text's words one after another."""

    columns = 1

    def __init__(self, splitter: Splitter, limit: int = KNOWN_WORDS):
        self.splitter, self.limit = splitter, limit
        self.words = pa.array([], pa.large_string())
        self.values = [pa.array([], pa.large_binary()) for _ in range(self.columns)]
        self.used = np.zeros(0, np.int64)  # the batch a word was last seen in
        self.batch = 0

    def worked_out(self, words: list[str]) -> list[list[bytes]]:
        """The values of new words, a list for each column."""
        raise NotImplementedError

    def of_special(self, number: int) -> list[bytes]:
        """The values of a special string, by its id."""
        raise NotImplementedError

    def of_texts(self, texts: pa.Array, end: bytes = b"") -> list[tuple[np.ndarray, np.ndarray]]:
        """For each column the bytes of all texts one after another, ``end`` behind each, and where each text
        starts, with the end of the last; null counts as empty."""
        if not len(texts):
            return [(np.zeros(0, np.uint8), np.zeros(1, np.int64)) for _ in range(self.columns)]
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        glued = np.flatnonzero(pc.match_substring_regex(texts, _GLUED).to_numpy(zero_copy_only=False))
        cut = pc.split_pattern(texts, " ")
        flat, starts = cut.flatten(), cut.offsets.to_numpy().astype(np.int64)
        starts -= starts[0]
        counts = np.diff(starts)
        if len(glued):  # these are cut behind words only
            own = [space_after_word(t) for t in texts.take(pa.array(glued)).to_pylist()]
            extra = pa.array([p for parts in own for p in parts], pa.large_string())
            begins = starts[:-1].copy()
            begins[glued] = len(flat) + np.r_[0, np.cumsum([len(p) for p in own])][:-1]
            counts[glued] = [len(p) for p in own]
            ends = np.cumsum(counts)
            place = np.arange(ends[-1]) + np.repeat(begins - (ends - counts), counts)
            flat = pa.concat_arrays([flat, extra]).take(pa.array(place))
        heads = np.cumsum(counts) - counts
        coded, opening = flat.dictionary_encode(), flat.take(pa.array(heads)).dictionary_encode()
        index = coded.indices.to_numpy().astype(np.int64)
        index[heads] = len(coded.dictionary) + opening.indices.to_numpy()
        if end:
            index = np.insert(index, heads + counts, len(coded.dictionary) + len(opening.dictionary))
        bounds = np.r_[0, np.cumsum(counts + bool(end))]
        found = []
        for values in self._pieces(coded.dictionary, opening.dictionary):
            out = pa.concat_arrays([values, pa.array([end], pa.large_binary())]).take(pa.array(index))
            offsets = np.frombuffer(out.buffers()[1], np.int64, len(out) + 1, 8 * out.offset)
            data = np.frombuffer(out.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
            found.append((data, offsets[bounds] - offsets[0]))
        pa.default_memory_pool().release_unused()
        return found

    def _pieces(self, inner: pa.Array, opening: pa.Array) -> list[pa.Array]:
        """The values of pieces with a space before them, then of pieces that open their texts."""
        own = pc.utf8_lower(inner) if self.splitter.normal else inner
        body = pc.utf8_rtrim(own, characters=TAIL)
        near = pc.invert(pc.or_(pc.match_substring_regex(inner, _FAR), pc.match_substring_regex(own, _FAR)))
        plain = pc.and_(pc.utf8_is_alpha(body), near).to_numpy(zero_copy_only=False) & self.splitter.plain
        fast, slow = np.flatnonzero(plain), np.flatnonzero(~plain)
        body = body.take(pa.array(fast))
        word = pc.binary_join_element_wise(_text(""), body, _text(" ")) if self.splitter.lead else body
        tail = pc.utf8_ltrim(own.take(pa.array(fast)), characters=_LETTERS)
        odd = [" " + p for p in inner.take(pa.array(slow)).to_pylist()] + opening.to_pylist()
        split = self.splitter.split(odd)
        parts = pa.array([w for own in split for w in own if w.__class__ is str], pa.large_string())
        coded = pa.concat_arrays([word, tail, parts]).dictionary_encode()
        index, n = coded.indices, len(fast)
        order = np.empty(len(inner) + len(opening), np.int64)
        order[fast], order[slow] = np.arange(n), n + np.arange(len(slow))
        order[len(inner) :] = np.arange(len(inner), len(order))
        special = {i: self.of_special(i) for i in self.splitter.special.ids.values()}
        found = []
        for column, values in enumerate(self._words(coded.dictionary)):
            simple = pc.binary_join_element_wise(
                values.take(index[:n]), values.take(index[n : 2 * n]), pa.scalar(b"", pa.large_binary())
            )
            known = iter(values.take(index[2 * n :]).to_pylist())
            rest = [b"".join([next(known) if w.__class__ is str else special[w][column] for w in own]) for own in split]
            found.append(pa.concat_arrays([simple, pa.array(rest, pa.large_binary())]).take(pa.array(order)))
        return found

    def _words(self, words: pa.Array) -> list[pa.Array]:
        """The values of each word; what is new is kept, what was not used for longest is forgotten."""
        self.batch += 1
        place = pc.index_in(words, value_set=self.words)
        new = words.filter(pc.is_null(place))
        self.used[pc.drop_null(place).to_numpy()] = self.batch
        fresh = self.worked_out(new.to_pylist())
        pools = [pa.concat_arrays([old, pa.array(more, pa.large_binary())]) for old, more in zip(self.values, fresh)]
        at = pc.fill_null(place, -1).to_numpy().astype(np.int64)
        at[at < 0] = len(self.words) + np.arange(len(new))
        found = [pool.take(pa.array(at)) for pool in pools]
        short = pc.less_equal(pc.utf8_length(new), KNOWN_CHARS).to_numpy(zero_copy_only=False)
        keep = np.r_[np.ones(len(self.words), bool), short]
        keys, used = pa.concat_arrays([self.words, new]), np.r_[self.used, np.full(len(new), self.batch)]
        if keep.sum() > self.limit:
            order = np.flatnonzero(keep)
            order = order[np.argsort(used[order], kind="stable")]
            keep[order[: len(order) - self.limit // 2]] = False
        if not keep.all():
            mask = pa.array(keep)
            keys, pools, used = keys.filter(mask), [pool.filter(mask) for pool in pools], used[keep]
        self.words, self.values, self.used = keys, pools, used
        return found


class Encoder(PieceColumns):
    """Texts to ids of one width in bytes, as the library encodes every distinct word."""

    def __init__(self, path: str, kind: str, limit: int = KNOWN_WORDS):
        self.tokenizer, self.kind = load(path), np.dtype(kind)
        super().__init__(Splitter(self.tokenizer, BYTE_PATTERN), limit)
        self.mark = separator(self.splitter.special)

    def encode(self, texts: pa.Array, end: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, ``end`` behind each, and how many each has."""
        ((data, bounds),) = self.of_texts(texts, end)
        return data.view(self.kind), np.diff(bounds) // self.kind.itemsize

    def of_special(self, number: int) -> list[bytes]:
        return [np.array([number], self.kind).tobytes()]

    def worked_out(self, words: list[str]) -> list[list[bytes]]:
        out: list[bytes] = []
        for some in groups(words):
            if self.mark is None:
                out += [np.array(e.ids, self.kind).tobytes() for e in self._library(some)]
                continue
            found = np.array(self._library([self.mark.join(some)])[0].ids, self.kind)
            cuts = (self.kind.itemsize * np.flatnonzero(found == self.splitter.special.ids[self.mark])).tolist()
            flat, width = found.tobytes(), self.kind.itemsize
            out += [flat[a:b] for a, b in zip([0, *(c + width for c in cuts)], [*cuts, len(flat)], strict=True)]
        if len(out) != len(words):
            raise ValueError("the library parted the words elsewhere")
        return [out]

    def _library(self, texts: list[str]):
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
