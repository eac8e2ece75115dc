"""Distinct rows of wide tables: by digests that are shuffled instead of rows, or by tasks of a bounded number of rows."""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions import column
from stratalake.session import MAX_SHUFFLE_TASKS, work_folder
from stratalake.sources.published import publish, read_table

_FIRST, _SECOND = "_digest_1", "_digest_2"
# Digests that occur more than once are broadcast up to this many: 16 bytes each, some 64 MB as a hash table.
MOST_REPEATED = 1_000_000
# Rows that one task holds while it compares them: 27 columns take some 450 bytes a row, twice, as Spark plans two aggregates.
ROWS_PER_TASK = 250_000
# Up to so many tasks, Spark's default, a shuffle writes rows straight to files; with more it sorts a scan's part in memory. So
# tasks may get up to FULLER times the rows before there are more.
DIRECT_WRITES, FULLER = 200, 6
# Buckets that rows are counted in, and from how many rows on a bucket may hold a row with very many copies.
BUCKETS, HOT_ROWS = 65_536, 10_000


def row_digests(df: DataFrame) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row with different seeds. Hashing passes over NULLs, so where they stand is hashed too."""
    values = [column(name) for name in df.columns]
    nulls = F.concat(*[value.isNull().cast("int").cast("string") for value in values])
    return F.xxhash64(*values, nulls), F.xxhash64(F.lit(1), nulls, *values)


def distinct_rows(
    df: DataFrame,
    digests: Callable[[DataFrame], tuple[Column, Column]] = row_digests,
    most_repeated: int = MOST_REPEATED,
) -> DataFrame:
    """The rows of ``dropDuplicates()``, for a stored table whose rows are wide and seldom repeat.

    A first job counts the digests, combined inside each map task, and stores those that occur more than once. A row whose digest is
    not among them is unique and goes straight from the scan to the result. The others are compared in full, so
    rows that differ under one digest all stay. The table is read three times and a shuffle moves 16 bytes a row instead of
    the row. With more than ``most_repeated`` repeated digests, which would be too many to broadcast, all rows are compared in
    full by ``distinct_in_tasks``. ``df`` must give the same rows each time it is read; an empty table stays empty, NULLs are equal to each other.
    """
    spark = df.sparkSession
    taken = {name.lower() for name in df.columns} & {_FIRST, _SECOND}
    if taken:
        raise ValueError(f"columns {sorted(taken)} are names of digests")
    first, second = digests(df)
    marked = df.withColumns({_FIRST: first, _SECOND: second})
    counts = marked.groupBy(_FIRST, _SECOND).agg(F.count(F.lit(1)).alias("n"))
    folder = work_folder(spark, "digests")
    found = publish(counts.where("n > 1").select(_FIRST, _SECOND), folder).rows
    if found == 0:
        return df
    if found > most_repeated:
        return distinct_in_tasks(df)
    repeated, both = F.broadcast(read_table(spark, folder)), [_FIRST, _SECOND]
    once = marked.join(repeated, both, "left_anti")
    again = marked.join(repeated, both, "left_semi")
    return once.select(*map(column, df.columns)).unionByName(again.select(*map(column, df.columns)).dropDuplicates())


def _tasks(rows: int, rows_per_task: int) -> int:
    tasks = max(1, ceil(rows / rows_per_task))
    return DIRECT_WRITES if DIRECT_WRITES < tasks <= FULLER * DIRECT_WRITES else min(tasks, MAX_SHUFFLE_TASKS)


def distinct_in_tasks(df: DataFrame, rows_per_task: int = ROWS_PER_TASK, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The rows of ``dropDuplicates()``, for wide rows: no task gathers the distinct rows of its whole part of a scan.

    A first job counts the rows by bucket of their hash, in memory that does not grow with the table. All rows are then dealt by
    their hash to about as many tasks as there are ``rows_per_task``, and compared in full there, in one shuffle. A row with so many
    copies that its bucket has over ``hot_rows`` rows and four times the mean would be too much for one task: rows of such
    buckets are combined inside each map task instead. These are few distinct rows, as hashes fill all other buckets evenly.
    ``df`` is read twice, three times with such buckets.
    """
    names = {name.lower() for name in df.columns}
    dealt = next(name for name in (f"_dealt{'_' * k}" for k in range(len(names) + 1)) if name not in names)
    marked = df.withColumn(dealt, F.xxhash64(*[column(name) for name in df.columns]))
    bucket = F.pmod(F.col(dealt), F.lit(BUCKETS))
    sizes = marked.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    large = F.when(F.col("n") > hot_rows, F.struct("bucket", "n"))
    found = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.collect_list(large).alias("large")).first()
    hot = [bucket_no for bucket_no, n in found["large"] if n * BUCKETS > 4 * found["total"]]
    tasks = _tasks(found["total"], rows_per_task)

    def compared(rows: DataFrame) -> DataFrame:
        return rows.repartition(tasks, dealt).dropDuplicates().drop(dealt)

    if not hot:
        return compared(marked)
    is_hot = bucket.isin(hot)
    return compared(marked.where(~is_hot)).unionByName(marked.where(is_hot).drop(dealt).dropDuplicates())
