"""Scalar column expressions. All of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortflow import defaults

# What counts as a number in a text value.
NUMBER_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"

# Abramowitz and Stegun 7.1.26: erfc(x) for x >= 0, absolute error below 1.5e-7.
ERFC_P = 0.3275911
ERFC_COEFFICIENTS = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def split_names(text: str | Iterable[str] | None) -> list[str]:
    """A comma list such as ``"a, b"`` as names; a sequence is taken as it is."""
    if not text:
        return []
    if isinstance(text, str):
        return [part.strip() for part in text.split(",")]
    return list(text)


def time_literal(value: str | datetime, like: DataFrame, column: str) -> Column:
    """A literal of the very type of ``column``, so that comparisons with it push down."""
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else str(value)
    return F.lit(text).cast(like.schema[_schema_name(like, column)].dataType)


def _schema_name(df: DataFrame, column: str) -> str:
    for name in df.columns:
        if name.lower() == column.lower():
            return name
    raise ValueError(f"column '{column}' not found in {df.columns}")


def days(count: int) -> Column:
    return F.expr(f"INTERVAL {int(count)} DAYS")


def age_on(birth: Column, on: Column) -> Column:
    """Whole years: year difference, less one while the birthday is still to come."""
    to_come = F.month(on) * 100 + F.dayofmonth(on) < F.month(birth) * 100 + F.dayofmonth(birth)
    return (F.year(on) - F.year(birth) - to_come.cast("int")).cast("int")


def tolerant_number(value: Column) -> Column:
    """The number a text holds, NULL when it holds none."""
    text = F.trim(value.cast("string"))
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def nan_as_missing(df: DataFrame) -> DataFrame:
    """``df`` with NULL for NaN in its floating-point columns, so that both count as missing."""
    floating = {f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    if not floating:
        return df
    columns = [(name, F.col("`" + name.replace("`", "``") + "`")) for name in df.columns]
    return df.select(*[nan_to_null(c).alias(n) if n in floating else c for n, c in columns])


def code_in(code: Column, codes: Sequence[str]) -> Column:
    """Membership in a code set, in the plain form that scans can push down. Nothing
    belongs to the empty set."""
    return code.cast("string").isin(list(codes)) if codes else F.lit(False)


def text_matches(text: Column, term: str) -> Column:
    """Case-insensitive regular expression search; NULL text does not match."""
    return F.coalesce(text.rlike("(?i)" + term), F.lit(False))


def ratio(numerator: Column, denominator: Column, default: float | None = None) -> Column:
    value = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return value if default is None else F.coalesce(value, F.lit(float(default)))


def erfc(x: Column) -> Column:
    """Complementary error function for x >= 0."""
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(ERFC_P) * x)
    polynomial = F.lit(0.0)
    for coefficient in reversed(ERFC_COEFFICIENTS):
        polynomial = (polynomial + F.lit(coefficient)) * t
    return polynomial * F.exp(-x * x)


def band(value: Column, bands: Sequence[tuple[float | None, str]]) -> Column:
    """Name of the first band whose exclusive upper bound lies above the value."""
    *bounded, (_, last) = bands
    chain = F.when(value.isNull(), F.lit(None).cast("string"))
    for upper, name in bounded:
        chain = chain.when(value < F.lit(float(upper)), name)
    return chain.otherwise(last)


def risk_band(score: Column, strict: bool = False) -> Column:
    """high / medium / low; ``strict`` uses > at the cut points instead of >=."""
    score = nan_to_null(score)
    high, medium = F.lit(defaults.RISK_HIGH), F.lit(defaults.RISK_MEDIUM)
    is_high, is_medium = (
        (score > high, score > medium) if strict else (score >= high, score >= medium)
    )
    return (
        F.when(is_high, "high").when(is_medium, "medium").when(score.isNotNull(), "low")
    )


def confidence(score: Column) -> Column:
    score = nan_to_null(score)
    # least() would skip a NULL score.
    return F.when(
        score.isNotNull(), F.least(F.lit(0.5) + F.abs(score - F.lit(0.5)), F.lit(1.0))
    )


def advice(band_name: Column) -> Column:
    chain = F
    for name, text in defaults.ADVICE.items():
        chain = chain.when(band_name == name, text)
    return chain
