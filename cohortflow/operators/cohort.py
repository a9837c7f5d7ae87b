"""Cohort selection."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow import defaults
from cohortflow.functions.scalars import age_on, code_in


def with_code(conditions: DataFrame, codes: Sequence[str], code: str = "Code") -> DataFrame:
    return conditions.where(code_in(F.col(code), codes))


def code_holders(
    conditions: DataFrame,
    codes: Sequence[str] = defaults.COHORT_CODES,
    entity: str = "Patient",
    code: str = "Code",
    flag: str = "diabetes",
) -> DataFrame:
    """Distinct entities holding any of the codes, flagged with a constant 1."""
    return with_code(conditions, codes, code).select(entity).distinct().withColumn(flag, F.lit(1))


def filter_by_age(
    patients: DataFrame,
    on: date | datetime | str | Column,
    min_age: int = defaults.MIN_AGE,
    birth: str = "BirthDate",
) -> DataFrame:
    """Adds ``age`` on the given date, or on each row's own, and keeps rows of at least ``min_age``."""
    reference = on.cast("date") if isinstance(on, Column) else F.lit(str(on)[:10]).cast("date")
    return patients.withColumn("age", age_on(F.col(birth), reference)).where(
        F.col("age") >= min_age
    )


def join_holders(
    patients: DataFrame, holders: DataFrame, patient_id: str = "Id", entity: str = "Patient"
) -> DataFrame:
    """Patients that are code holders. Holders are distinct, so a semi join suffices."""
    return patients.join(holders, patients[patient_id] == holders[entity], "left_semi")


def build_cohort(
    patients: DataFrame,
    conditions: DataFrame,
    reference_date: date | datetime | str | Column,
    min_age: int = defaults.MIN_AGE,
    codes: Sequence[str] = defaults.COHORT_CODES,
    patient_id: str = "Id",
    birth: str = "BirthDate",
    entity: str = "Patient",
    code: str = "Code",
    time_type: str = "timestamp",
) -> DataFrame:
    """(patient, age, as_of): code holders of at least ``min_age`` on the reference date.

    The date is one for all, or a column of ``patients``; who has none is left out.
    """
    holders = code_holders(conditions, codes, entity, code)
    # The age filter runs before the join: it needs no other table.
    adults = filter_by_age(patients, reference_date, min_age, birth)
    own = isinstance(reference_date, Column)
    as_of = reference_date if own else F.lit(str(reference_date))
    return join_holders(adults, holders, patient_id, entity).select(
        F.col(patient_id).alias("patient"), "age", as_of.cast(time_type).alias("as_of")
    )
