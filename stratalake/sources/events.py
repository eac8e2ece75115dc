"""Stored events: which files count, their lines, and typed reading that keeps what cannot be decoded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions import column
from stratalake.sources.files import Files
from stratalake.sources.published import is_published, read_table, snapshot

# The columns of a stored event that hold its text and its type.
RAW_PAYLOAD = "_raw_data"
TYPE_COLUMN = "tipo_mensagem"
DAY_COLUMNS = ("ingest_year", "ingest_month", "ingest_day")
# Columns that decoding adds: why an event is refused or was changed, and its stored line.
REASON, REFUSED_LINE = "_refused", "_refused_line"
NO_JSON, BAD_PAYLOAD, NO_FIELD, MISFIT = "line is no JSON object", "payload is no JSON object", "no declared field", "value does not fit"

LINE, FILE = "line", "_file"
_LINES = T.StructType([T.StructField("value", T.StringType()), *[T.StructField(n, T.StringType()) for n in (TYPE_COLUMN, *DAY_COLUMNS)]])


def decode_events(stored: DataFrame, schema: T.StructType) -> DataFrame:
    """The fields of ``schema`` from the raw payload of every stored event; NULLs where it is not JSON."""
    return stored.select(F.from_json(column(RAW_PAYLOAD), schema).alias("event")).select(
        *[F.col("event").getField(name).alias(name) for name in schema.fieldNames()]
    )


# --- files ----------------------------------------------------------------------------------------


def _typed_folders(store: str) -> str:
    return f"{store.rstrip('/')}/{TYPE_COLUMN}=*"


def has_log(spark: SparkSession, store: str) -> bool:
    """Whether a stream wrote the store."""
    return bool(Files(spark).names(_log(store)))


def _log(store: str) -> str:
    return f"{store.rstrip('/')}/_spark_metadata"


def inside_store(path: Column) -> Column:
    """The part of a file's path from its type on: logs and scans write the same address in different ways."""
    return F.regexp_extract(path, rf"({TYPE_COLUMN}=.*)$", 1)


def merged_root(store: str) -> str:
    """Where the merged lines of a store are published."""
    return f"{store.rstrip('/')}/_merged"


def files_outside_log(spark: SparkSession, store: str) -> list[str]:
    """Files of a streamed store that the stream did not commit: delivered by hand, or left by a failed attempt.

    Compares the two file listings that Spark makes on the driver for reading; no data are read. A store without a
    log has none, as all of its files are read.
    """
    committed = set(spark.read.text(store).inputFiles())
    try:
        present = spark.read.option("basePath", store).text(_typed_folders(store)).inputFiles()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        present = []
    return sorted(set(present) - committed)


def committed_files(spark: SparkSession, store: str) -> DataFrame:
    """(path, file, type, day) of every file that the stream committed, from its log; nothing for a store without one.

    Spark's log has a file per batch and, now and then, one that sums up all before it. Its lines are read as a table, so that
    sets of files are compared by joins.
    """
    schema = "path string, action string"
    found = Files(spark).names(_log(store))
    sums = [int(n.removesuffix(".compact")) for n in found if n.removesuffix(".compact").isdigit() and n.endswith(".compact")]
    last = max(sums, default=-1)
    names = [f"{last}.compact"] * (last >= 0) + [n for n in found if n.isdigit() and int(n) > last]
    if names:
        # Spark's file sources take the folder of a stream's log for no data, so its lines come as an RDD of text.
        lines = spark.sparkContext.textFile(",".join(f"{_log(store)}/{n}" for n in names))
        entries = spark.read.schema(schema).json(lines).where("path is not null")
        gone = entries.where("action = 'delete'").select("path")
        listed = entries.where("action = 'add'").select("path").distinct().join(gone, "path", "left_anti")
    else:
        listed = spark.createDataFrame([], "path string")
    return listed.select(
        "path", inside_store(F.col("path")).alias(FILE), F.regexp_extract("path", rf"/{TYPE_COLUMN}=([^/]*)/", 1).alias(TYPE_COLUMN),
        F.concat_ws("-", *[F.regexp_extract("path", rf"/{n}=([^/]*)/", 1) for n in DAY_COLUMNS]).alias("day"),
    )


def merged_files(spark: SparkSession, store: str) -> DataFrame:
    """(path) of the committed files whose lines are in the merged table."""
    state = snapshot(spark, merged_root(store))
    folders = [f"{merged_root(store)}/_files/{x}" for x in (state.notes["files"] if state else [])]
    return spark.read.schema("path string").parquet(*folders) if folders else spark.createDataFrame([], "path string")


def _read_lines(spark: SparkSession, store: str, paths: str | Sequence[str]) -> DataFrame:
    text = spark.read.schema(_LINES)
    if paths != store:
        text = text.option("basePath", store)
    names = (TYPE_COLUMN, *DAY_COLUMNS)
    return text.text(paths if isinstance(paths, str) else list(paths)).select(
        F.col("value").alias(LINE), *names, inside_store(F.col("_metadata.file_path")).alias(FILE)
    )


def no_lines(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], f"{LINE} string, {TYPE_COLUMN} string, {', '.join(f'{n} string' for n in DAY_COLUMNS)}, {FILE} string")


def lines_of(spark: SparkSession, store: str, paths: Sequence[str]) -> DataFrame:
    """The lines of some files of the store."""
    return _read_lines(spark, store, paths) if paths else no_lines(spark)


def event_lines(spark: SparkSession, store: str, event_type: str | None = None, committed_only: bool = True) -> DataFrame:
    """Every stored line once, with its type, day and file: those of merged files from the merged table, others from their files.

    Without a merge the store is read from its root, where Spark finds the stream's log. After one the files that are not
    merged yet, those of the last days, are listed one by one. With ``committed_only=False`` files outside the log count too.
    """
    if is_published(spark, merged_root(store)):
        merged = read_table(spark, merged_root(store))
        if event_type is not None:
            merged = merged.where(column(TYPE_COLUMN) == event_type)
        live = committed_files(spark, store)
        live = live if event_type is None else live.where(column(TYPE_COLUMN) == event_type)
        paths = [r[0] for r in live.join(merged_files(spark, store), "path", "left_anti").select("path").collect()]
        if not committed_only:
            outside = files_outside_log(spark, store)
            paths += [p for p in outside if event_type is None or f"/{TYPE_COLUMN}={event_type}/" in p]
        found = merged.unionByName(lines_of(spark, store, sorted(set(paths))))
    else:
        found = _read_lines(spark, store, store if committed_only else _typed_folders(store))
    return found if event_type is None else found.where(column(TYPE_COLUMN) == event_type)


# --- decoding -------------------------------------------------------------------------------------


def decode_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """The fields of ``schema`` of every line, and REASON and REFUSED_LINE where something is wrong with it.

    A line holds the event itself or an envelope with the event as text; where it has both forms the envelope wins. Refused
    are lines and payloads that are no JSON object, and those without any declared field. A value that does not fit its type
    becomes NULL and is a reason too, but such an event counts. Blank lines are nothing. All are built-in expressions.
    """
    corrupt = "_corrupt"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    fields = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    flat = T.StructType([T.StructField(RAW_PAYLOAD, T.StringType()), *fields.fields])
    line = column(LINE)
    both = lines.where(F.trim(line) != "").withColumn("_flat", F.from_json(line, flat, options))
    both = both.withColumn("_event", F.from_json(F.col("_flat").getField(RAW_PAYLOAD), fields, options))
    payload = F.col("_flat").getField(RAW_PAYLOAD)
    values = [F.coalesce(F.col("_event").getField(n), F.col("_flat").getField(n)) for n in schema.fieldNames()]

    def broken(text: Column) -> Column:
        return ~F.coalesce(F.get_json_object(text, "$"), F.lit("")).startswith("{")

    reason = (
        F.when(broken(line), NO_JSON)
        .when(payload.isNotNull() & broken(payload), BAD_PAYLOAD)
        .when(F.coalesce(*[v.cast("string") for v in values]).isNull(), NO_FIELD)
        .when(F.coalesce(F.col("_event").getField(corrupt), F.col("_flat").getField(corrupt)).isNotNull(), MISFIT)
    )
    named = [v.alias(n) for v, n in zip(values, schema.fieldNames())]
    return both.select(*named, reason.alias(REASON), F.when(reason.isNotNull(), line).alias(REFUSED_LINE))


def is_event() -> Column:
    """Whether a decoded line counts as an event."""
    return column(REASON).isNull() | (column(REASON) == MISFIT)


def accepted(decoded: DataFrame) -> DataFrame:
    """The events that count, without the columns of the reasons."""
    return decoded.where(is_event()).drop(REASON, REFUSED_LINE)


def read_events(
    spark: SparkSession, store: str, event_type: str, schema: T.StructType, committed_only: bool = True
) -> DataFrame:
    """Events of one type from an event store of JSON lines, without those that cannot be decoded.

    Of a streamed store only what the stream committed counts, so files of a failed attempt do not; the filter on the
    type leaves only that type's folders to read. Only declared fields are returned: the ingestion day is not part of an
    event, so a redelivered event equals its first copy. With ``committed_only=False`` all files of the type folders count,
    also those outside the log. ``decode_lines`` of ``event_lines`` tells what was refused.
    """
    return accepted(decode_lines(event_lines(spark, store, event_type, committed_only), schema))
