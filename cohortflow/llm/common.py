"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of text that a task holds as Python objects at once.
SLICE_CHARS = 4_000_000

#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def texts_in_slices(column: pa.Array, most: int = SLICE_CHARS) -> Iterator[list[str]]:
    """Texts of an Arrow column in order, null as empty, a few million bytes at a time."""
    column = column.cast(pa.large_string())
    start, held = 0, 0
    sizes = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_pylist()
    for i, n in enumerate(sizes):
        if held and held + n > most:
            yield [x or "" for x in column.slice(start, i - start).to_pylist()]
            start, held = i, 0
        held += n + 64
    if start < len(sizes):
        yield [x or "" for x in column.slice(start).to_pylist()]


def with_struct(df: DataFrame, value: Column, names: list[str]) -> DataFrame:
    """``df`` with the fields of a struct column as columns ``names``; columns of ``df`` that
    have one of these names, whatever the case, give way."""
    taken = {n.lower() for n in names}
    kept = [F.col(quoted(c)) for c in df.columns if c.lower() not in taken]
    held = unused(df, "struct")
    return df.select(*[F.col(quoted(c)) for c in df.columns], value.alias(held)).select(
        *kept, *[F.col(held).getField(n).alias(n) for n in names]
    )


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def unused(df: DataFrame, label: str) -> str:
    """A column name that ``df`` does not have."""
    name = f"_{label}"
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def spread(text: Column, most: Column | int, stretches: int = 10) -> Column:
    """A text of up to ``most`` characters whole, else as many of them in stretches that lie evenly over
    it from its start to its end, on lines of their own."""
    n = F.length(text)
    size = F.greatest(F.floor((most if isinstance(most, Column) else F.lit(most)) / stretches), F.lit(1)).cast("int")
    steps = F.sequence(F.lit(0), F.lit(stretches - 1))
    parts = F.transform(steps, lambda i: F.substring(text, F.floor((n - size) * i / (stretches - 1)).cast("int") + 1, size))
    return F.when(n <= most, text).otherwise(F.array_join(parts, "\n"))


def held_out(id_col: str) -> Column:
    """The quarter of the ids that no model learns from; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(quoted(id_col)).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def hash_fraction(id_col: str, salt: str) -> Column:
    """A number in [0, 1) that depends on the id and the salt alone."""
    mixed = F.xxhash64(F.lit(salt), F.col(quoted(id_col)).cast("string"))
    return F.pmod(mixed, F.lit(1 << 40)) / float(1 << 40)


def n_words(text: Column) -> Column:
    """Words as ``WORD`` has them, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
