"""Reporting questions over the gold tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions import column, gap, target_of_year


def with_gap(
    fact: DataFrame, realised: str, target_prefix: str, years: Iterable[int], year: str
) -> DataFrame:
    """The fact with ``target`` (that of the row's own year) and ``gap``; both NULL without a target.

    The gap is the plain difference: rounding it would move values on a rounding edge.
    """
    return fact.withColumn("target", target_of_year(column(year), target_prefix, years)).withColumn(
        "gap", gap(column(realised), F.col("target"))
    )


def target_hit(gaps: DataFrame) -> DataFrame:
    """``hit``: 1 where the target was reached, 0 where it was missed, NULL where there is none."""
    return gaps.withColumn("hit", (F.col("gap") >= 0).cast("int"))


def realised_vs_target(gaps: DataFrame, key: str, year: str, realised: str) -> DataFrame:
    """One row per entity and year: realised value, target, gap and hit."""
    return target_hit(gaps).select(
        column(key), column(year), column(realised).alias("realised"), "target", "gap", "hit"
    )


def top_bottom(gaps: DataFrame, key: str, year: str, n: int) -> DataFrame:
    """The ``n`` largest and ``n`` smallest gaps of each year with their rank.

    Rows without a target take no part; ties go to the smaller key. Because only the first ``n`` ranks
    are kept, every map task drops the rest of its rows before the shuffle, so a year with most of the
    rows reaches its task as a few rows per map task.
    """
    candidates = gaps.where(F.col("gap").isNotNull()).select(column(year), column(key), "gap")

    def half(label: str, order: Column) -> DataFrame:
        by_gap = Window.partitionBy(column(year)).orderBy(order, column(key).asc())
        ranked = candidates.withColumn("position", F.row_number().over(by_gap)).where(F.col("position") <= n)
        return ranked.withColumn("ranking", F.lit(label))

    return half("top", F.desc("gap")).unionByName(half("bottom", F.asc("gap")))


def by_region(gaps: DataFrame, regions: DataFrame, key: str, year: str, realised: str) -> DataFrame:
    """Mean realised value, target and gap per region and year, and how many entities hit their target.

    ``regions`` maps ``key`` to ``region``; entities it does not list form the region "Unknown". A key listed
    several times counts once, in its smallest region.
    """
    single = regions.groupBy(column(key)).agg(F.min("region").alias("region"))
    mapped = target_hit(gaps).join(single, on=key, how="left")
    return mapped.groupBy(F.coalesce("region", F.lit("Unknown")).alias("region"), column(year)).agg(
        F.round(F.avg(column(realised)), 2).alias("mean_realised"),
        F.round(F.avg("target"), 2).alias("mean_target"),
        F.round(F.avg("gap"), 2).alias("mean_gap"),
        F.count("target").alias("with_target"),
        F.coalesce(F.sum("hit"), F.lit(0)).alias("hits"),
    )


def national_kpis(
    national_gaps: DataFrame, students: DataFrame, year: str, realised: str, assessed: str
) -> DataFrame:
    """Per year: national rate, target, gap and the number of assessed students.

    The gap is the mean gap of the rows that have a target. Rows of totals and of their parts should not be mixed: filter
    ``national_gaps`` to one network first.
    """
    rates = national_gaps.groupBy(column(year)).agg(
        F.round(F.avg(column(realised)), 2).alias("rate"),
        F.round(F.avg("target"), 2).alias("target"),
        F.round(F.avg("gap"), 2).alias("gap"),
    )
    counts = students.groupBy(column(year)).agg(F.sum(column(assessed)).alias("assessed_students"))
    return rates.join(counts, on=year, how="left")
