"""Cleaning of one table from its spec."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions import column, lenient_cast, normalise_code
from stratalake.operators.distinct import distinct_in_tasks, distinct_rows
from stratalake.specs import TableSpec


class SpecError(ValueError):
    """The frame and its spec do not fit together."""


def require_columns(df: DataFrame, names, what: str) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise SpecError(f"{what}: columns {missing} are not in {df.columns}")


def all_present(names) -> Column:
    return reduce(and_, [column(name).isNotNull() for name in names])


def cleaned_names(columns: list[str], spec: TableSpec) -> list[str]:
    """Column names after the renames; two columns must not end up with one name."""
    names = [spec.renames.get(name, name) for name in columns]
    folded = [name.lower() for name in names]
    clashes = sorted({name for name in names if folded.count(name.lower()) > 1})
    if clashes:
        raise SpecError(f"{spec.name}: renaming gives {clashes} more than once")
    return names


def project(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows cast, normalised and renamed; columns that the spec does not name stay as they are."""
    names = cleaned_names(df.columns, spec)

    def cleaned(raw: str) -> Column:
        value = column(raw)
        if raw in spec.casts:
            value = lenient_cast(value, df.schema[raw].dataType, spec.casts[raw])
        if raw in spec.codes:
            value = normalise_code(value)
        return value

    return df.select(*[cleaned(raw).alias(name) for raw, name in zip(df.columns, names)])


def clean(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Distinct rows with all required keys, then cast, normalised and renamed.

    Duplicates are judged on the raw values, so " ro" and "RO" stay two rows. Rows without a key are
    filtered first: that commutes with removing duplicates, reaches the Parquet scan as a pushed filter
    and keeps those rows out of the shuffle. The distinct step combines copies inside each map task
    before it shuffles, so many copies of one row cost one row per task. Wide rows would fill such a
    task's memory: they are shuffled as they are and compared by tasks of few rows, see ``distinct_in_tasks``.
    """
    require_columns(df, [*spec.required, *spec.casts, *spec.codes, *spec.renames], spec.name)
    cleaned_names(df.columns, spec)
    keyed = df.where(all_present(spec.required))
    return project(distinct_in_tasks(keyed) if spec.wide else keyed.dropDuplicates(), spec)


def clean_stored(df: DataFrame, spec: TableSpec) -> DataFrame:
    """``clean`` of a stored table with wide rows: its duplicates are found by digests, see ``distinct_rows``."""
    require_columns(df, [*spec.required, *spec.casts, *spec.codes, *spec.renames], spec.name)
    cleaned_names(df.columns, spec)
    return project(distinct_rows(df.where(all_present(spec.required))), spec)


def presence_split(df: DataFrame, flag: str) -> DataFrame:
    """Rows present (flag 1) and absent (flag 0), counted in one pass. A NULL flag is neither."""
    return df.agg(
        F.count_if(column(flag) == 1).alias("present"),
        F.count_if(column(flag) == 0).alias("absent"),
    )
