"""Profiles of columns that merge: rows, NULLs, smallest and largest value, measured once for each write and partition.

A profile is a small table with the columns of ``SCHEMA``, one row per column and one without a name for the part itself. Values are kept
as text that reads back as the same value: moments as microseconds, others as Spark casts them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions import column

SCHEMA = "_column string, _rows bigint, _nulls bigint, _low string, _high string"
_ORDERED = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def _kept(value: Column, kind: T.DataType) -> Column:
    return (F.unix_micros(value) if isinstance(kind, T.TimestampType) else value).cast("string")


def _restored(text: Column, kind: T.DataType) -> Column:
    """The value of a kept text, as ``kind``; a moment may have been kept as the day it was when it was measured."""
    if isinstance(kind, T.TimestampType):
        return F.coalesce(F.timestamp_micros(text.try_cast("bigint")), text.try_cast("date").cast(kind))
    return text.try_cast(kind)


def ordered(kind: T.DataType) -> bool:
    """Whether smallest and largest values of a type are kept."""
    return isinstance(kind, _ORDERED)


def carries(before: T.StructField, now: T.DataType) -> bool:
    """Whether what was measured as ``before`` still holds for the values as ``now``: not if other types became text."""
    if before.metadata.get("unknown"):
        return isinstance(now, T.StringType)
    return before.dataType == now or not isinstance(now, T.StringType)


def measures(df: DataFrame) -> list[Column]:
    """Aggregates of all columns, which a write job can compute on its way."""
    found = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(df.schema.fields):
        value = column(f.name)
        found.append(F.count(value).alias(f"count_{i}"))
        if ordered(f.dataType):
            found += [_kept(F.min(value), f.dataType).alias(f"low_{i}"), _kept(F.max(value), f.dataType).alias(f"high_{i}")]
    return found


def entries(schema: T.StructType, found: Mapping) -> list[tuple]:
    """The rows of a profile from the values of ``measures``."""
    every = found["rows"]
    return [(None, every, 0, None, None)] + [
        (f.name, every, every - found[f"count_{i}"], found.get(f"low_{i}"), found.get(f"high_{i}")) for i, f in enumerate(schema.fields)
    ]


def profiled(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The profile of ``df``, or one for each group of ``by``, whose columns come first; one pass with partial aggregates."""
    nothing = F.lit(None).cast("string")
    every = F.col("_measured.rows")
    found = [F.struct(nothing.alias("_column"), every.alias("_rows"), F.lit(0).cast("bigint").alias("_nulls"), nothing.alias("_low"), nothing.alias("_high"))]
    for i, f in enumerate(df.schema.fields):
        low, high = ((F.col(f"_measured.{n}_{i}") if ordered(f.dataType) else nothing) for n in ("low", "high"))
        nulls = every - F.col(f"_measured.count_{i}")
        found.append(F.struct(F.lit(f.name).alias("_column"), every.alias("_rows"), nulls.alias("_nulls"), low.alias("_low"), high.alias("_high")))
    keys = [column(k) for k in by]
    # The struct keeps names of measures apart from those of the keys.
    groups = df.groupBy(*keys).agg(F.struct(*[m.alias(n) for m, n in _named(df)]).alias("_measured"))
    return groups.select(*keys, F.inline(F.array(*found)))


def _named(df: DataFrame) -> list[tuple[Column, str]]:
    names = ["rows"]
    for i, f in enumerate(df.schema.fields):
        names += [f"count_{i}"] + ([f"low_{i}", f"high_{i}"] if ordered(f.dataType) else [])
    return list(zip(measures(df), names, strict=True))


def merged(parts: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per column of ``schema`` from the profiles of all parts: column_name, row_count, null_count, low, high (text).

    Rows of a part that lacks a column count as NULLs of it. ``low`` and ``high`` are NULL for types without an order and columns without a value.
    """
    own = [F.col("_column") == f.name for f in schema.fields]
    found = [F.coalesce(F.sum(F.when(F.col("_column").isNull(), F.col("_rows"))), F.lit(0)).alias("rows")]
    for i, (f, mine) in enumerate(zip(schema.fields, own)):
        present = F.sum(F.when(mine, F.col("_rows") - F.col("_nulls")))
        found.append(F.coalesce(present, F.lit(0)).alias(f"count_{i}"))
        for n, pick in (("low", F.min), ("high", F.max)):
            best = pick(F.when(mine, _restored(F.col(f"_{n}"), f.dataType))) if ordered(f.dataType) else F.lit(None)
            found.append(best.cast("string").alias(f"{n}_{i}"))
    totals = parts.agg(*found)
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"), F.col("rows").alias("row_count"), (F.col("rows") - F.col(f"count_{i}")).alias("null_count"),
            F.col(f"low_{i}").alias("low"), F.col(f"high_{i}").alias("high"),
        )
        for i, f in enumerate(schema.fields)
    ]
    return totals.select(F.inline(F.array(*rows)))
