"""Batch sinks. All replace what is there; partitioned ones only the partitions they write."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions import column
from stratalake.sources.published import Written, publish
from stratalake.sources.readers import csv_variants, read_csv, read_csv_text


def write_parquet(df: DataFrame, path: str) -> int:
    """Replace the table at ``path`` and return the number of rows, counted by the write job itself.

    Readers see the old rows until the new ones are complete; see ``published``.
    """
    return publish(df, path).rows


def write_partitioned(
    df: DataFrame, path: str, *partition_columns: str, rebalance: bool = True, whole: bool = False
) -> int:
    """Replace the partitions present in ``df``, or with ``whole`` the table, and return the number of rows.

    Without a shuffle each task would write a small file into every partition. Rebalancing gathers a
    partition's rows into files of the advisory size; AQE splits a partition that holds a large share of
    the table over many tasks. ``rebalance=False`` is for frames that hold one partition anyway.
    """
    return publish(df, path, *partition_columns, how="table" if whole else "partitions", rebalance=rebalance).rows


def ingestion_columns() -> dict[str, Column]:
    """Ingestion time and its UTC day. Spark evaluates current_timestamp once per query, so all agree."""
    now = F.current_timestamp()
    utc = F.to_utc_timestamp(now, F.current_timezone())
    return {
        "_bronze_timestamp": now,
        "ingest_year": F.date_format(utc, "yyyy"),
        "ingest_month": F.date_format(utc, "MM"),
        "ingest_day": F.date_format(utc, "dd"),
    }


def land_csv(
    spark: SparkSession,
    landing: str,
    path: str,
    separator: str = ",",
    schema: T.StructType | None = None,
    at_least: Mapping[str, T.DataType] | None = None,
    variants: bool = False,
    unreadable: str = "_unreadable",
) -> Written:
    """Land a folder of CSV files under the ingestion day.

    Landing again on the same day replaces that day; earlier days stay. All rows go to one day, so the scan tasks write
    directly, without a shuffle. The text is read once: with ``schema`` values are parsed, and a line with a value that does not fit is
    kept whole in the column ``unreadable`` and counted; otherwise the text is stored and the write job finds the types of
    all columns (see ``published``; ``at_least`` names types a column has at least). With ``variants`` the files may differ in order and
    choice of columns: each header is read by its names, absent columns are NULL. Without it they must share one header.
    A landed column with the name of an ingestion column is an error.
    """
    if variants and schema is not None:
        raise ValueError("a declared schema has one header")
    if variants:
        frames = csv_variants(spark, landing, separator)
        if not frames:
            raise FileNotFoundError(f"no file with a header in {landing}")
        df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    elif schema is None:
        df = read_csv_text(spark, landing, separator)
    else:
        df = read_csv(spark, landing, separator, schema, unreadable=unreadable)
    added = ingestion_columns()
    taken = {name.lower() for name in added} & {name.lower() for name in df.columns}
    if taken:
        raise ValueError(f"landed columns have names of ingestion columns: {sorted(taken)}")
    counting = {unreadable: F.count(column(unreadable))} if schema is not None else {}
    day = ("ingest_year", "ingest_month", "ingest_day")
    return publish(df.withColumns(added), path, *day, how="partitions", infer=schema is None, at_least=at_least, rebalance=False, counting=counting)
