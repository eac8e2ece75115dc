"""Star schema: dimensions, facts against targets, aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions import column, normalise_code
from stratalake.operators.clean import require_columns


def dimension(df: DataFrame, key: str) -> DataFrame:
    """Distinct values of ``key``, sorted."""
    return df.select(column(key)).distinct().orderBy(column(key))


def dimension_with_lookup(df: DataFrame, key: str, lookup: DataFrame, attribute: str) -> DataFrame:
    """Distinct ``key`` values with ``attribute`` from ``lookup``; keys the lookup lacks keep NULL.

    A key with several attribute values gets the smallest normalised one, so the result does not depend
    on row order. Both sides are reduced to one row per key before the join and stay partitioned on it,
    so the join adds no shuffle of its own; Spark broadcasts a side only after measuring its size.
    """
    keys = df.select(column(key)).distinct()
    attributes = lookup.groupBy(column(key)).agg(F.min(normalise_code(column(attribute))).alias(attribute))
    return keys.join(attributes, on=key, how="left").orderBy(column(key))


def fact_vs_target(
    realised: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, str],
    targets: Mapping[str, str | Column],
) -> DataFrame:
    """Realised rows with the target that shares their keys; rows without a target stay, with NULLs.

    ``measures`` maps realised columns to fact columns and ``targets`` maps fact columns to target
    columns or expressions. The fact holds no repeated rows. Each side is made distinct before the join:
    two different pairs of distinct rows always differ in the joined row, so nothing is left to remove
    afterwards. That keeps copies out of the join shuffle, and with no operator above the join that
    needs its partitioning AQE is free to split a hot key over many tasks.
    """
    require_columns(realised, [*keys, *measures], "realised")
    require_columns(target, [*keys, *[c for c in targets.values() if isinstance(c, str)]], "target")
    left = realised.select(
        *[column(k) for k in keys], *[column(c).alias(name) for c, name in measures.items()]
    ).dropDuplicates()
    right = target.select(
        *[column(k) for k in keys],
        *[(column(c) if isinstance(c, str) else c).alias(name) for name, c in targets.items()],
    ).dropDuplicates()
    return left.join(right, on=list(keys), how="left")


def aggregate_present(
    df: DataFrame,
    flag: str,
    keys: Mapping[str, str],
    mean_of: Mapping[str, str],
    percent_of: Mapping[str, str],
    count_of: Mapping[str, str],
) -> DataFrame:
    """Rounded means, rounded percentages of 0/1 flags and non-null counts over the rows with flag 1.

    Every mapping goes from input column to output column. Partial aggregation runs before the shuffle,
    so a hot group sends one row per map task.
    """
    return (
        df.where(column(flag) == 1)
        .groupBy(*[column(c).alias(name) for c, name in keys.items()])
        .agg(
            *[F.round(F.avg(column(c)), 2).alias(name) for c, name in mean_of.items()],
            *[F.round(F.avg(column(c)) * 100, 2).alias(name) for c, name in percent_of.items()],
            *[F.count(column(c)).alias(name) for c, name in count_of.items()],
        )
    )
