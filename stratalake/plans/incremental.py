"""Silver tables of events that grow with what has arrived, instead of being built anew from the whole history."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions import column
from stratalake.operators.clean import all_present, project, require_columns
from stratalake.plans import literacy_tables as tables
from stratalake.session import work_folder
from stratalake.sources.events import (
    FILE,
    TYPE_COLUMN,
    accepted,
    committed_files,
    decode_lines,
    has_log,
    lines_of,
    merged_files,
    merged_root,
)
from stratalake.sources.published import is_published, publish, read_table, snapshot
from stratalake.specs import TableSpec

# Identifies a raw event: rows with the same SHA-256 are the same row.
DIGEST = "_digest"


@dataclass(frozen=True)
class Update:
    """What an update did: files it read, rows it added, and of the rows it read those that were there already."""

    files: int
    added: int
    known: int


def row_digest(df: DataFrame) -> Column:
    """SHA-256 of a row. As JSON with names a NULL differs from every value and values cannot run into each other."""
    return F.unhex(F.sha2(F.to_json(F.struct(*[column(n) for n in df.columns])), 256))


def _consumed(spark: SparkSession, root: str) -> DataFrame:
    state = snapshot(spark, root)
    folders = [f"{root}/_consumed/{x}" for x in (state.notes["consumed"] if state else [])]
    return spark.read.schema("path string").parquet(*folders) if folders else spark.createDataFrame([], "path string")


def update_events(spark: SparkSession, store: str, root: str, spec: TableSpec, kind: str) -> Update:
    """Bring the events of files that were not read before into the silver table published at ``root``.

    The table then equals ``clean`` over the whole store. Files are those of the stream's log that the table's manifest does not
    name yet; merged ones are read from the merged table. New rows are decoded, made distinct and stored with their
    digests. Of the history only the digests are read: a semi-join keeps those that came again, which Spark does with a
    broadcast of the new digests while these are few, so that the history is not shuffled; an anti-join then leaves the rows that are
    new. Rows and file names are published by one manifest: an update that ends half way is simply done again.
    """
    if not has_log(spark, store):
        raise ValueError(f"{store} has no log of a stream: clean it whole")
    require_columns(spark.createDataFrame([], spec.schema), spec.required, spec.name)
    of_kind = committed_files(spark, store).where(column(TYPE_COLUMN) == kind).select("path", FILE)
    waiting = of_kind.join(_consumed(spark, root), "path", "left_anti")
    merged = merged_files(spark, store)
    # The names of the files of one update come to the driver, which has to open them.
    live = [r[0] for r in waiting.join(merged, "path", "left_anti").select("path").collect()]
    inside = [(r[0], r[1]) for r in waiting.join(merged, "path", "left_semi").collect()]
    if not live and not inside and is_published(spark, root):
        return Update(0, 0, 0)
    lines = lines_of(spark, store, sorted(live))
    if inside:
        names = spark.createDataFrame([(f,) for _, f in inside], f"{FILE} string")
        held = read_table(spark, merged_root(store)).where(column(TYPE_COLUMN) == kind)
        lines = lines.unionByName(held.join(names, FILE, "left_semi").select(*lines.columns))
    events = accepted(decode_lines(lines, spec.schema)).where(all_present(spec.required))
    staged = work_folder(spark, "events")
    found = publish(events.withColumn(DIGEST, row_digest(events)).dropDuplicates([DIGEST]), staged).rows
    fresh = read_table(spark, staged)
    state = snapshot(spark, root)
    if state:
        again = read_table(spark, root).select(DIGEST).join(fresh.select(DIGEST), DIGEST, "left_semi")
        fresh = fresh.join(again, DIGEST, "left_anti")
    name = uuid.uuid4().hex
    read = [(p,) for p in live] + [(p,) for p, _ in inside]
    spark.createDataFrame(read, "path string").coalesce(1).write.parquet(f"{root}/_consumed/{name}")
    known = state.notes["consumed"] if state else []
    made = project(fresh.select(*events.columns, DIGEST), spec)
    added = publish(made, root, how="append" if state else "table", notes={"consumed": [*known, name]}).rows
    return Update(len(read), added, found - added)


def silver_events(spark: SparkSession, root: str) -> DataFrame:
    """The rows of an updated silver table."""
    return read_table(spark, root).drop(DIGEST)


def run_silver_events(spark: SparkSession, store: str, silver: str) -> dict[str, Update]:
    """Update the silver tables of all event types from the store."""
    return {s.name: update_events(spark, store, f"{silver}/{s.name}", s, kind) for kind, s in tables.EVENTS.items()}
