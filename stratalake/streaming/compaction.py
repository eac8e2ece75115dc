"""Merging the small files that a stream has written, while readers and the stream go on."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from stratalake.sources.events import DAY_COLUMNS, TYPE_COLUMN, committed_files, lines_of, merged_files, merged_root
from stratalake.sources.files import Files
from stratalake.sources.published import publish, snapshot
from stratalake.sources.writers import ingestion_columns


def _today() -> Column:
    added = ingestion_columns()
    return F.concat_ws("-", *[added[n] for n in DAY_COLUMNS])


def merge_events(spark: SparkSession, store: str, before: str | None = None) -> int:
    """Put the committed files of past days into the merged table; the number of files merged.

    ``before`` is the first day (YYYY-MM-DD, UTC) that is left alone, today unless given: the stream still writes there. The new
    rows and the list of the files they came from are published by one manifest, so a reader sees each line once, before,
    during and after, and a merge that ends half way changes nothing. Files that come late for a merged day are merged by the next
    run. The names of the files of one run come to the driver, which has to open them.
    """
    limit = F.lit(before) if before else _today()
    waiting = committed_files(spark, store).where(F.col("day") < limit)
    waiting = waiting.join(merged_files(spark, store), "path", "left_anti")
    paths = sorted(r[0] for r in waiting.select("path").collect())
    if not paths:
        return 0
    root = merged_root(store)
    state = snapshot(spark, root)
    name = uuid.uuid4().hex
    lines = lines_of(spark, store, paths)
    spark.createDataFrame([(p,) for p in paths], "path string").coalesce(1).write.parquet(f"{root}/_files/{name}")
    known = state.notes["files"] if state else []
    publish(lines, root, TYPE_COLUMN, *DAY_COLUMNS, how="append", notes={"files": [*known, name]})
    return len(paths)


def remove_merged_files(spark: SparkSession, store: str) -> int:
    """Delete the small files whose lines are merged; the number deleted.

    Call it when no reader can still hold a listing from before the merge. The stream's own log goes on naming them, so from then on
    the store is read with ``event_lines`` or ``read_events`` only.
    """
    files = Files(spark)
    return sum(files.delete(r[0]) for r in merged_files(spark, store).toLocalIterator())
