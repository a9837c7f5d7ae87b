"""Token counts by rank-synchronous merging of ragged arrays."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from cohortflow.llm.common import quoted, texts_in_slices, with_struct
from cohortflow.llm.pieces import BYTE_PATTERN, PieceTable, Splitter, kept_by_worker, load, release

#: Symbols that are merged side by side.
SYMBOLS_AT_ONCE = 2_000_000
NO_MERGE = np.iinfo(np.int32).max


class RankMerger:
    """Byte-pair merges over many sequences of bytes at once."""

    def __init__(self, tokenizer):
        model = json.loads(tokenizer.to_str())["model"]
        vocab = model["vocab"]
        self.size = max(vocab.values()) + 1
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int32)
        # The character that stands for each byte, from the library's own pre-tokenizer.
        self.symbol = np.full(256, -1, np.int32)
        for c in [*range(0x800), *range(0x800, 0xD800, 0x40), *range(0xE000, 0x110000, 0x400)]:
            shown = "".join(w for w, _ in tokenizer.pre_tokenizer.pre_tokenize_str(chr(c)))
            self.symbol[list(chr(c).encode())] = [vocab[x] for x in shown]
        # Ranks by pair, in a table with open addressing.
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in merges], np.int64)
        self.slots = np.full(1 << 19, -1, np.int64)
        self.slot_rank = np.full(1 << 19, NO_MERGE, np.int32)
        self.probes = 0
        left = np.arange(len(keys))
        while len(left):
            at = self._slot(keys[left], self.probes)
            free = self.slots[at] < 0
            self.slots[at[free]] = keys[left[free]]
            own = self.slots[at] == keys[left]
            self.slot_rank[at[own]] = left[own]
            left, self.probes = left[~own], self.probes + 1

    def _slot(self, keys: np.ndarray, probe: int) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed >> np.uint64(45)).astype(np.int64) + probe) & (len(self.slots) - 1)

    def _rank(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys, 0)
        found = np.where(self.slots[at] == keys, self.slot_rank[at], NO_MERGE)
        open_ = np.flatnonzero((self.slots[at] != keys) & (self.slots[at] >= 0))
        for probe in range(1, self.probes):
            if not len(open_):
                break
            at = self._slot(keys[open_], probe)
            own = self.slots[at] == keys[open_]
            found[open_[own]] = self.slot_rank[at[own]]
            open_ = open_[~own & (self.slots[at] >= 0)]
        return found

    def counts(self, words: list[str]) -> np.ndarray:
        """Tokens of each word."""
        out, start, held = [], 0, 0
        for i, w in enumerate(words):
            held += len(w)
            if held > SYMBOLS_AT_ONCE:
                out.append(self._counts(words[start : i + 1]))
                start, held = i + 1, 0
        out.append(self._counts(words[start:]))
        return np.concatenate(out)

    def _counts(self, words: list[str]) -> np.ndarray:
        tokens = np.zeros(len(words), np.int64)
        held = np.frombuffer("".join(words).encode(), np.uint8)
        chars = np.r_[np.flatnonzero(held & 0xC0 != 0x80), len(held)]  # where each begins
        ends = chars[np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))] if words else chars[:0]
        row = np.repeat(np.arange(len(words)), np.diff(ends, prepend=0))
        symbols = self.symbol[held]
        row, symbols = row[symbols >= 0], symbols[symbols >= 0]
        while len(symbols):
            pair_rank = np.full(len(symbols), NO_MERGE, np.int32)  # of a symbol and the next
            same = np.flatnonzero(row[:-1] == row[1:])
            pair_rank[same] = self._rank(symbols[same].astype(np.int64) * self.size + symbols[same + 1])
            first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            lowest = np.minimum.reduceat(pair_rank, first)
            sizes = np.diff(np.r_[first, len(row)])
            done = lowest == NO_MERGE
            tokens[row[first[done]]] = sizes[done]
            lowest = np.repeat(lowest, sizes)
            going = lowest != NO_MERGE
            row, symbols, pair_rank, lowest = row[going], symbols[going], pair_rank[going], lowest[going]
            if not len(row):
                break
            hit = pair_rank == lowest
            # In a run of hits, which is a run of one symbol, every second one merges.
            place = np.arange(len(hit))
            run = np.maximum.accumulate(np.where(hit & ~np.r_[False, hit[:-1]], place, 0))
            hit &= (place - run) % 2 == 0
            symbols = np.where(hit, self.merged[np.where(hit, lowest, 0)], symbols)
            stays = ~np.r_[False, hit[:-1]]
            row, symbols = row[stays], symbols[stays]
        return tokens


@kept_by_worker
def _piece_counts(path: str) -> PieceTable:
    tokenizer = load(path)
    merger, splitter = RankMerger(tokenizer), Splitter(tokenizer, BYTE_PATTERN)

    def values(pieces: list[str]) -> list[int]:
        split = splitter.split(pieces)
        place: dict[str, int] = {}
        for own in split:
            for w in own:
                if w.__class__ is str:
                    place.setdefault(w, len(place))
        counts = dict(zip(place, merger.counts(list(place)).tolist()))
        return [sum([counts.get(w, 1) for w in own]) for own in split]

    return PieceTable(values)


def count_tokens(
    docs: DataFrame, tokenizer_path: str, limit: int = 1024, text_col: str = "text"
) -> DataFrame:
    """``docs`` with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) of every whole text.

    Counts equal the tokenizers library's without added special tokens; special strings inside a
    text count as one token. A null or empty text has 0 bytes and 0 tokens; texts of any length are counted whole. Repeated rows each get
    their count; an empty table gives an empty one; columns of these three names are replaced.
    The tokenizer must be byte-level BPE with no normalizer.
    """
    if load(tokenizer_path).normalizer is not None:
        raise ValueError("the tokenizer changes texts before it splits them")

    @arrow_udf("struct<n_bytes long, n_tokens long, over_limit boolean>")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release(keep=_piece_counts)
        table = _piece_counts(tokenizer_path)
        for column in batches:
            n = [sum(row) for texts in texts_in_slices(column) for row in table.rows(texts)]
            tokens = pa.array(n, pa.int64())
            size = pa.compute.fill_null(pa.compute.binary_length(column), 0).cast(pa.int64())
            yield pa.StructArray.from_arrays(
                [size, tokens, pa.compute.greater(tokens, limit)], names=["n_bytes", "n_tokens", "over_limit"]
            )

    return with_struct(docs, counted(F.col(quoted(text_col))), ["n_bytes", "n_tokens", "over_limit"])
