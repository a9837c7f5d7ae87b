"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features are shapes of the line itself and of its neighbours; the field
adds weights for two neighbouring labels. Training lines carry their document's label. For a document,
forward and backward sums give the marginal probability of each line to be good, and the mean of these
by line length is the document's quality.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from cohortflow.llm.common import hash_fraction, held_out, quoted, spread, texts_in_slices, with_struct
from cohortflow.llm.pieces import release

#: Labelled documents of each class that the field is fitted on, about.
SAMPLE_DOCS = 1_000
#: Of a longer document, evenly spread stretches of so many characters together are fitted on (every
#: document is scored whole).
SAMPLE_DOC_CHARS = 20_000
STEPS, RATE, RIDGE = 150, 0.1, 1e-3
THRESHOLD = 0.7
#: Documents whose lines are in memory side by side, by lines.
LINES_AT_ONCE = 100_000

SEPARATORS = "|<>{}[]=\\/_~^"
SIGNS = "!#$%&*+@?"
_SPLIT = re.compile(r"\r\n|\r|\n")
_CLASSES = np.zeros(0x110000, np.uint8)
LETTER, UPPER, DIGIT, SPACE, SIGN, SEPARATOR, STOP, OTHER = range(1, 9)


def _class_of(c: str) -> int:
    if c.isalpha():
        return UPPER if c.isupper() else LETTER
    if c.isdigit():
        return DIGIT
    if c.isspace():
        return SPACE
    return SIGN if c in SIGNS else SEPARATOR if c in SEPARATORS else STOP if c in ".,;:'\"-()" else OTHER


def _classes(points: np.ndarray) -> np.ndarray:
    found = _CLASSES[points]
    if not found.all():
        for p in np.unique(points[found == 0]):
            _CLASSES[p] = _class_of(chr(p))
        found = _CLASSES[points]
    return found


NAMES = (
    "bias letters upper digits signs separators stops other short long word_length long_words sign_words "
    "upper_words repeats distinct neighbours_equal line_again stop_at_end lower_at_start"
).split()


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """A row of shapes for each line that is not blank, and the lines' lengths."""
    lines = [line for line in _SPLIT.split(text) if line and not line.isspace()]
    lengths = np.array([len(line) for line in lines], float)
    out = np.zeros((len(lines), len(NAMES)))
    if not lines:
        return out, lengths
    classes = _classes(np.frombuffer("\n".join(lines).encode("utf-32-le"), np.uint32))
    starts = np.r_[0, np.cumsum(lengths[:-1] + 1)].astype(np.int64)
    counts = np.stack([np.add.reduceat(classes == k, starts, dtype=np.int64) for k in range(1, 9)], 1).astype(float)
    counts[:-1, SPACE - 1] -= 1  # the line break
    dark = np.maximum(lengths - counts[:, SPACE - 1], 1)
    letters = counts[:, LETTER - 1] + counts[:, UPPER - 1]
    out[:, 0] = 1
    out[:, 1] = letters / dark
    out[:, 2] = counts[:, UPPER - 1] / np.maximum(letters, 1)
    for k, c in enumerate((DIGIT, SIGN, SEPARATOR, STOP, OTHER)):
        out[:, 3 + k] = np.sqrt(counts[:, c - 1] / dark)
    out[:, 8], out[:, 9] = lengths < 20, np.minimum(lengths / 500, 2)
    again: dict[str, int] = {}
    for i, line in enumerate(lines):
        words = line.split()
        n = len(words)
        distinct = set(words)
        mean = dark[i] / n
        out[i, 10] = min(mean, 30.0) / 10
        out[i, 11] = mean > 12
        out[i, 12] = sum([not w[-1].isalnum() and w[-1] not in ".,;:" for w in distinct]) / len(distinct)
        out[i, 13] = sum([w.isupper() and len(w) > 1 for w in distinct]) / len(distinct)
        out[i, 14] = 1 - len(distinct) / n if n > 30 else (n - len(distinct)) / n * min(1.0, n / 10)
        out[i, 15] = min(len(distinct), 50) / 50
        out[i, 16] = sum([a == b for a, b in zip(words, words[1:])]) / n
        out[i, 17] = line in again
        again[line] = i
        last = line.rstrip()[-1]
        out[i, 18] = last in ".!?"
        out[i, 19] = line.lstrip()[:1].islower()
    return out, lengths


def with_neighbours(features: np.ndarray) -> np.ndarray:
    """Each line's shapes, then those of the line before and after (zeros beyond the ends)."""
    empty = np.zeros((1, features.shape[1]))
    return np.hstack([features, np.vstack([empty, features[:-1]]), np.vstack([features[1:], empty])])


@dataclass
class Field:
    """Weights of good against bad for a line's features, and of staying in a label against leaving it."""

    weights: np.ndarray
    stay: float

    def marginals(self, lines: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The probability of each line to be good; documents begin at ``starts``."""
        return _chain(lines @ self.weights, self.stay, starts)[0]


def _chain(logits: np.ndarray, stay: float, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of good lines, and of each line to have the label of the one before (0 for first
    lines), by forward and backward sums over all documents side by side, one line of each at a time.

    With two labels, a message is one number: the logarithm of the sums' ratio, good to bad.
    """
    sizes = np.diff(np.r_[starts, len(logits)])
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    steps = int(sizes.max(initial=0))
    going = np.searchsorted(-sizes, -np.arange(1, steps + 1), "right")
    forward, backward = np.zeros(len(logits)), np.zeros(len(logits))

    def pass_on(ratio: np.ndarray) -> np.ndarray:
        return np.logaddexp(ratio + stay, 0) - np.logaddexp(ratio, stay)

    for t in range(1, steps):
        here = starts[: going[t]] + t
        forward[here] = pass_on(forward[here - 1] + logits[here - 1])
    for t in range(steps - 1, 0, -1):
        here = starts[: going[t]] + t
        backward[here - 1] = pass_on(backward[here] + logits[here])
    good = 1 / (1 + np.exp(-np.clip(forward + logits + backward, -500, 500)))
    same = np.zeros(len(logits))
    later = np.ones(len(logits), bool)
    later[starts] = False
    i = np.flatnonzero(later)
    left, right = forward[i - 1] + logits[i - 1], logits[i] + backward[i]
    alike = np.logaddexp(left + right, 0) + stay
    same[i] = 1 / (1 + np.exp(np.clip(np.logaddexp(left, right) - alike, -500, 500)))
    return good, same


def fit_field(docs: list[tuple[np.ndarray, int]], good_share: float = 0.5) -> Field:
    """Gradient steps (Adam) on the likelihood of the documents' lines. Classes weigh as they do in all
    labels, ``good_share`` being that of label 1, and documents alike, however many lines they have."""
    docs = [(with_neighbours(f), y) for f, y in docs if len(f)]
    if not docs:
        return Field(np.zeros(3 * len(NAMES)), 0.0)
    lines = np.vstack([f for f, _ in docs])
    sizes = np.array([len(f) for f, _ in docs])
    starts = np.r_[0, np.cumsum(sizes[:-1])]
    labels = np.array([y for _, y in docs])
    good, bad = max(1, (labels == 1).sum()), max(1, (labels == 0).sum())
    share = np.where(labels == 1, good_share / good, (1 - good_share) / bad)
    weight = np.repeat(share / sizes, sizes)
    label = np.repeat(labels, sizes)
    joined = np.ones(len(lines))
    joined[starts] = 0
    value = np.zeros(lines.shape[1] + 1)
    mean, square = np.zeros_like(value), np.zeros_like(value)
    for step in range(1, STEPS + 1):
        good, same = _chain(lines @ value[:-1], value[-1], starts)
        slope = np.r_[lines.T @ (weight * (good - label)), (weight * joined * (same - 1)).sum()] + RIDGE * value
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        value -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Field(value[:-1], float(value[-1]))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    sample_docs: int = SAMPLE_DOCS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> Field:
    """A field fitted on about ``sample_docs`` labelled documents of each class, those whose ids have the
    smallest hashes, without the held-out ones. The sample meets on the driver: at most about
    2 x ``sample_docs`` texts, of each up to about ``SAMPLE_DOC_CHARS`` characters."""
    rows = labels.where(~held_out(id_col)).select(
        F.col(quoted(id_col)).alias("doc_id"),
        F.col(quoted(label_col)).cast("int").alias("y"),
        hash_fraction(id_col, "quality").alias("hash"),
    ).where("y in (0, 1) and doc_id is not null")
    counts = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}  # two rows
    share = {y: sample_docs / n for y, n in counts.items()}
    drawn = rows.where(F.col("hash") < F.when(F.col("y") == 1, share.get(1, 0.0)).otherwise(share.get(0, 0.0)))
    ids = drawn.select("doc_id", "y").collect()  # about sample_docs of each class
    if not ids:
        return fit_field([])
    spark = docs.sparkSession
    chosen = F.broadcast(spark.createDataFrame([(r["doc_id"], r["y"]) for r in ids], "doc_id long, y int").distinct())
    texts = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text_col)).alias("text")).where(
        "text is not null"
    )
    drawn_texts = texts.join(chosen, "doc_id").select("doc_id", spread(F.col("text"), SAMPLE_DOC_CHARS).alias("text"), "y")
    sample = drawn_texts.collect()
    sample.sort(key=lambda r: (r["doc_id"], r["y"], r["text"]))
    good_share = counts.get(1, 0) / sum(counts.values())
    return fit_field([(line_features(r["text"])[0], r["y"]) for r in sample], good_share)


def score_texts(field: Field, texts: list[str]) -> np.ndarray:
    """Quality of each text: marginals of its lines, weighed by length; without lines 0."""
    scores = np.zeros(len(texts))
    held: list[tuple[int, np.ndarray, np.ndarray]] = []

    def flush() -> None:
        if held:
            lines = np.vstack([f for _, f, _ in held])
            starts = np.r_[0, np.cumsum([len(f) for _, f, _ in held])[:-1]]
            length = np.concatenate([n for _, _, n in held])
            good = field.marginals(lines, starts)
            scores[[i for i, _, _ in held]] = np.add.reduceat(good * length, starts) / np.add.reduceat(length, starts)
        held.clear()

    lines = 0
    for i, text in enumerate(texts):
        features, lengths = line_features(text)
        if len(features):
            held.append((i, with_neighbours(features), lengths))
            lines += len(features)
        if lines > LINES_AT_ONCE:
            flush()
            lines = 0
    flush()
    return np.clip(scores, 0, 1)


def score(docs: DataFrame, field: Field, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: good likelier) and ``predicted`` (1 from ``threshold`` on) of
    every whole text.

    A null or empty text and one of blank lines have score 0. Texts and lines of any length are scored whole. Repeated
    rows each get their score, an empty table gives an empty one, and columns of the two names are replaced.
    """

    @arrow_udf("struct<score double, predicted int>")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release()
        for column in batches:
            found = np.concatenate([np.zeros(0), *[score_texts(field, texts) for texts in texts_in_slices(column)]])
            yield pa.StructArray.from_arrays(
                [pa.array(found, pa.float64()), pa.array((found >= threshold).astype(np.int32), pa.int32())],
                names=["score", "predicted"],
            )

    return with_struct(docs, scored(F.col(quoted(text_col))), ["score", "predicted"])
