"""Data-quality checks. Each returns a small DataFrame; none caches or collects its input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions import column
from stratalake.operators.clean import all_present, require_columns
from stratalake.specs import TableSpec


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, null_count) for every column, or for ``columns`` only, from one pass.

    Written as row count minus non-null count: an empty table gives zeros, and both counts can come from
    Parquet footers when the session enables aggregate pushdown.
    """
    names = list(columns or df.columns)
    require_columns(df, names, "null_profile")
    totals = df.agg(*[(F.count(F.lit(1)) - F.count(column(name))).alias(name) for name in names])
    return totals.unpivot([], [column(name) for name in names], "column_name", "null_count")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many key groups repeat, how many rows are beyond the first of their group, and whether any does.

    With all columns as ``keys`` surplus_rows is the row count minus the distinct row count.
    """
    sizes = df.groupBy(*[column(k) for k in keys]).agg(F.count(F.lit(1)).alias("group_rows"))
    return sizes.where(F.col("group_rows") > 1).agg(
        F.count(F.lit(1)).alias("duplicate_groups"),
        F.coalesce(F.sum(F.col("group_rows") - 1), F.lit(0)).alias("surplus_rows"),
        (F.count(F.lit(1)) > 0).alias("has_duplicates"),
    )


def orphans(df: DataFrame, reference: DataFrame, keys: Sequence[str | tuple[str, str]]) -> DataFrame:
    """Keys of ``df`` that ``reference`` lacks, with their row counts.

    A pair names a key that is called differently on the two sides. A key with a NULL part matches
    nothing and is an orphan. Both sides are reduced to distinct keys first, so a hot key is one row in
    the join, which reuses the partitioning of the two aggregates.
    """
    pairs = [(k, k) if isinstance(k, str) else k for k in keys]
    found = df.groupBy(*[column(left) for left, _ in pairs]).agg(F.count(F.lit(1)).alias("row_count"))
    known = reference.select(
        *[column(right).alias(left) for left, right in pairs]
    ).distinct()
    return found.join(known, on=[left for left, _ in pairs], how="left_anti")


def orphan_summary(df: DataFrame, reference: DataFrame, keys: Sequence[str | tuple[str, str]]) -> DataFrame:
    """Number of orphan keys and of rows that carry one, and whether there is any."""
    return orphans(df, reference, keys).agg(
        F.count(F.lit(1)).alias("orphan_keys"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("orphan_rows"),
        (F.count(F.lit(1)) > 0).alias("has_orphans"),
    )


def volume(df: DataFrame) -> DataFrame:
    """Row count and whether the table holds anything."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count", F.when(F.col("row_count") == 0, "empty").otherwise("ok").alias("status")
    )


def cleaning_effect(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows before and after cleaning, and why rows go: a required key is missing, or they are copies.

    One pass: the rows are grouped as cleaning groups them, and the group sizes tell both counts.
    """
    groups = df.groupBy(*[column(name) for name in df.columns]).agg(F.count(F.lit(1)).alias("_copies"))
    keyed = all_present(spec.required)
    copies = F.col("_copies")

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    return groups.agg(
        total(copies).alias("rows_before"),
        total(F.when(~keyed, copies)).alias("rows_without_key"),
        total(F.when(keyed, copies - 1)).alias("surplus_copies"),
        F.count_if(keyed).alias("rows_after"),
    )


def fact_profile(df: DataFrame, key: str, measure: str, period: str) -> DataFrame:
    """Rows, missing keys, missing measures, measure range and covered periods (also listed) of a fact."""
    per_period = df.groupBy(column(period).alias("period")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(column(key)).alias("n_key"),
        F.count(column(measure)).alias("n_measure"),
        F.min(column(measure)).alias("low"),
        F.max(column(measure)).alias("high"),
    )
    return per_period.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.col("n") - F.col("n_key")), F.lit(0)).alias("null_keys"),
        F.coalesce(F.sum(F.col("n") - F.col("n_measure")), F.lit(0)).alias("null_measures"),
        F.min("low").alias("min_measure"),
        F.max("high").alias("max_measure"),
        F.count("period").alias("periods"),
        F.min("period").alias("first_period"),
        F.max("period").alias("last_period"),
        # One entry per period, as the rows were grouped by it.
        F.array_join(F.sort_array(F.collect_list(F.col("period"))).cast("array<string>"), ",").alias("period_list"),
    )
