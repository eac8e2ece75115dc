"""Tables that change at once: every write makes new folders, and a manifest says which folders the table consists of.

``root``/_data/_version=<id> holds the files of one write, ``root``/_published/<number>.json the manifests. Readers take the
manifest with the highest number, so a write that ends half way is never seen. A plain read of ``root`` finds no files.

``root``/_profiles holds, for writes that asked for it, the profile of each partition they wrote (see ``profiles``), and results
that were kept for one published state.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions import column
from stratalake.sources import lattice, profiles
from stratalake.sources.files import Files

VERSION = "_version"


class Conflict(RuntimeError):
    """Somebody else published the table after this write had begun."""


@dataclass(frozen=True)
class Part:
    """A folder of a table: the write it belongs to, its partition ("" without), the columns of its files and their types."""

    version: str
    partition: str
    columns: str
    types: str


@dataclass(frozen=True)
class Written:
    """What a write did: its rows, the values of ``counting``, and the types it decided on."""

    rows: int
    counts: Mapping[str, int]
    schema: T.StructType


@dataclass(frozen=True)
class Snapshot:
    """A published state. ``written`` counts the partitions of each write, ``rows`` its rows; ``notes`` are the writer's own.

    ``types`` are those of the last write, which hold where the table has no part.
    """

    number: int
    partition_by: tuple[str, ...]
    partition_types: str
    parts: tuple[Part, ...]
    written: Mapping[str, int] = field(default_factory=dict)
    rows: Mapping[str, int] = field(default_factory=dict)
    notes: Mapping = field(default_factory=dict)
    types: str = ""

    def schema(self) -> T.StructType:
        """Columns of all parts with types that hold all of them, then the partition columns."""
        schemas = dict.fromkeys(p.types for p in self.parts) or [self.types or T.StructType([]).json()]
        held = lattice.join_schemas(*[_schema(s) for s in schemas])
        return T.StructType([*held.fields, *_schema(self.partition_types).fields])


def _schema(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


def _manifest(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/_published/{number:012d}.json"


def _folder(root: str, version: str, partition: str = "") -> str:
    return f"{root.rstrip('/')}/_data/{VERSION}={version}/{partition}".rstrip("/")


def _profile_folder(root: str, version: str, partition: str = "") -> str:
    return f"{root.rstrip('/')}/_profiles/{VERSION}={version}/{partition}".rstrip("/")


def _numbers(files: Files, root: str) -> list[int]:
    names = files.names(f"{root.rstrip('/')}/_published")
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def snapshot(spark: SparkSession, root: str, number: int | None = None) -> Snapshot | None:
    """The last published state, or that of ``number``; None where nothing is published."""
    files = Files(spark)
    numbers = [n for n in _numbers(files, root) if number is None or n == number]
    if not numbers:
        return None
    read = json.loads(files.read(_manifest(root, numbers[-1])))
    parts = tuple(Part(*[read["texts"][x] if i > 1 else x for i, x in enumerate(p)]) for p in read["parts"])
    return Snapshot(numbers[-1], tuple(read["partition_by"]), read["partition_types"], parts, read["written"], read["rows"], read["notes"], read.get("types", ""))


def _text(s: Snapshot) -> str:
    texts = list(dict.fromkeys(t for p in s.parts for t in (p.columns, p.types)))
    place = {t: i for i, t in enumerate(texts)}
    parts = [(p.version, p.partition, place[p.columns], place[p.types]) for p in s.parts]
    return json.dumps({
        "partition_by": s.partition_by, "partition_types": s.partition_types, "texts": texts, "parts": parts,
        "written": s.written, "rows": s.rows, "notes": s.notes, "types": s.types,
    })


def publish(
    df: DataFrame,
    root: str,
    *partition_by: str,
    how: str = "table",
    infer: bool = False,
    at_least: Mapping[str, T.DataType] | None = None,
    rebalance: bool = True,
    notes: Mapping | None = None,
    counting: Mapping[str, Column] | None = None,
    without: Sequence[str] = (),
    after: int | None = None,
    profile: bool = False,
) -> Written:
    """Write ``df`` and publish it. The write job itself counts the rows and the aggregates of ``counting``.

    ``how`` says what becomes of the parts that are published already: "table" replaces all, "partitions" those whose partition was
    written, "append" none. ``infer`` types the text columns by their values: the files keep the text,
    the bits of ``lattice`` are aggregated by the write job, and reading casts. So a later write with wider values changes the type
    of a column without a rewrite, and no text is lost. ``notes`` replace those of the last state.

    With "partitions" the partitions ``without`` (such as "year=2024") go too, written or not. ``after`` is the number of
    the state, 0 for none, that ``df`` was made from; if another one is the last by now that is a ``Conflict``.

    ``profile`` keeps the profile of every partition for ``table_profile``. The write job measures it where a table has no partitions and
    types are known; otherwise the files just written are read once.

    Only ``append`` may meet a state published meanwhile: it is put on top of that. Others raise ``Conflict``, and nothing changes.
    """
    if how not in ("table", "partitions", "append"):
        raise ValueError(f"how: {how!r}")
    if VERSION in df.columns:
        raise ValueError(f"{VERSION} is a name of published tables")
    spark, files = df.sparkSession, Files(df.sparkSession)
    before = snapshot(spark, root)
    if after is not None and after != (before.number if before else 0):
        raise Conflict(f"{root} was published by somebody else after number {after}")
    if before and how != "table" and before.partition_by != partition_by:
        raise ValueError(f"{root} is partitioned by {before.partition_by}, not by {partition_by}")
    version, watched = uuid.uuid4().hex, Observation()
    content = df.drop(*partition_by)
    placed = df.hint("rebalance", *[column(n) for n in partition_by]) if partition_by and rebalance else df
    counting = dict(counting or {})
    measured = [F.count(F.lit(1)).alias("rows"), *[c.alias(f"count {n}") for n, c in counting.items()]]
    measured += lattice.kinds(content) if infer else []
    at_once = profile and not infer and not partition_by
    # Its first measure is the number of rows, which is measured already.
    measured += profiles.measures(content)[1:] if at_once else []
    writer = placed.observe(watched, *measured).write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(_folder(root, version))
    found = watched.get
    types = lattice.decided(content, found, at_least) if infer else content.schema
    partitions = files.folders(_folder(root, version), len(partition_by))
    made = [Part(version, p, content.schema.json(), types.json()) for p in partitions]
    partition_types = T.StructType([df.schema[name] for name in partition_by]).json()
    if profile and made:
        new = Snapshot(0, partition_by, partition_types, tuple(made), {version: len(partitions)}, types=types.json())
        if at_once:
            kept = spark.createDataFrame(profiles.entries(content.schema, found), profiles.SCHEMA)
        else:
            kept = profiles.profiled(_read(spark, root, new), partition_by)
        # One task holds a partition's profile, so that each folder gets one small file.
        kept = kept.repartition(*[column(n) for n in partition_by]) if partition_by else kept.coalesce(1)
        (kept.write.partitionBy(*partition_by) if partition_by else kept.write).parquet(_profile_folder(root, version))

    while True:
        kept = [] if before is None or how == "table" else list(before.parts)
        if how == "partitions":
            kept = [p for p in kept if p.partition not in {*partitions, *without}]
        parts = tuple(kept + made)
        used = {p.version for p in parts}
        older = before or Snapshot(0, partition_by, partition_types, ())
        written = {**{v: n for v, n in older.written.items() if v in used}, version: len(partitions)}
        rows = {**{v: n for v, n in older.rows.items() if v in used}, version: found["rows"]}
        state = Snapshot(older.number + 1, partition_by, partition_types, parts, written, rows, dict(older.notes if notes is None else notes), types.json())
        try:
            files.create(_manifest(root, state.number), _text(state))
            return Written(found["rows"], {n: found[f"count {n}"] for n in counting}, types)
        except FileExistsError:
            if how != "append":
                raise Conflict(f"{root} was published by somebody else as number {state.number}") from None
            before = snapshot(spark, root)


def read_table(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The last published state of a table, or that of ``number``.

    Parts with the same file columns are one scan. Columns that a part lacks are NULL; types are those that hold all parts.
    Filters on partition columns choose folders before anything is read.
    """
    state = snapshot(spark, root, number)
    if state is None:
        raise FileNotFoundError(f"nothing is published in {root}")
    return _read(spark, root, state)


def _read(spark: SparkSession, root: str, state: Snapshot, schema: T.StructType | None = None) -> DataFrame:
    schema = schema or state.schema()
    groups: dict[str, list[Part]] = {}
    for part in state.parts:
        groups.setdefault(part.columns, []).append(part)
    if not groups:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, [_scan(spark, root, state, columns, parts, schema) for columns, parts in groups.items()])


def _scan(spark: SparkSession, root: str, state: Snapshot, columns: str, parts: list[Part], schema: T.StructType) -> DataFrame:
    stored = _schema(columns)
    paths = _paths(root, state, parts, _folder)
    fields = [*stored.fields, *_schema(state.partition_types).fields, T.StructField(VERSION, T.StringType())]
    files = spark.read.schema(T.StructType(fields)).option("basePath", f"{root.rstrip('/')}/_data").parquet(*paths)
    own = {f.name: f.dataType for f in fields}

    def taken(f: T.StructField):
        value = lattice.typed(column(f.name), own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType)
        return value.alias(f.name)

    return files.select(*[taken(f) for f in schema.fields])


def _paths(root: str, state: Snapshot, parts: list[Part], folder) -> list[str]:
    by_version: dict[str, list[str]] = {}
    for part in parts:
        by_version.setdefault(part.version, []).append(part.partition)
    # A write whose partitions all count is read by its folder.
    whole = {v for v, own in by_version.items() if len(own) == state.written.get(v)}
    return [folder(root, v, p) for v, own in by_version.items() for p in ([""] if v in whole else own)]


def table_profile(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """Per column of the published state: column_name, row_count, null_count, low, high, from kept profiles.

    Only parts without a usable profile are scanned: those written without one, and those with a column that was no text when it was
    measured and is text by now, as text has another order. See ``profiles.merged``.
    """
    state = snapshot(spark, root, number)
    if state is None:
        raise FileNotFoundError(f"nothing is published in {root}")
    schema = state.schema()
    kept = set(Files(spark).names(f"{root.rstrip('/')}/_profiles"))
    carried = {text: all(profiles.carries(f, schema[f.name].dataType) for f in _schema(text).fields) for text in {p.types for p in state.parts}}
    usable = [p for p in state.parts if f"{VERSION}={p.version}" in kept and carried[p.types]]
    others = tuple(p for p in state.parts if p not in set(usable))
    names = [c.strip().split()[0] for c in profiles.SCHEMA.split(",")]
    found = spark.createDataFrame([], profiles.SCHEMA)
    if usable:
        stored = spark.read.schema(profiles.SCHEMA).option("basePath", f"{root.rstrip('/')}/_profiles")
        found = found.union(stored.parquet(*_paths(root, state, usable, _profile_folder)).select(*names))
    if others:
        found = found.union(profiles.profiled(_read(spark, root, replace(state, parts=others), schema)))
    return profiles.merged(found, schema)


def kept_result(spark: SparkSession, root: str, number: int, name: str, make: Callable[[], object]):
    """What ``make`` gave for the state ``number``: kept as JSON beside the profiles, since a published state never changes."""
    path = f"{root.rstrip('/')}/_profiles/{number:012d}-{name}.json"
    files = Files(spark)
    if files.exists(path):
        return json.loads(files.read(path))
    result = make()
    try:
        files.create(path, json.dumps(result))
    except FileExistsError:
        pass
    return result


def is_published(spark: SparkSession, root: str) -> bool:
    return bool(_numbers(Files(spark), root))


def retire(spark: SparkSession, root: str, keep: int = 2, min_age_s: int = 86_400) -> int:
    """Delete the manifests before the last ``keep`` and the writes that no kept manifest names; the number of writes deleted.

    Writes younger than ``min_age_s`` stay: they may be about to be published. Older ones that never were go.
    """
    if keep < 1:
        raise ValueError("the last state cannot be retired")
    files = Files(spark)
    numbers = _numbers(files, root)
    used = {p.version for n in numbers[-keep:] for p in snapshot(spark, root, n).parts}
    for n in numbers[:-keep]:
        files.delete(_manifest(root, n))
    gone = 0
    for name, changed in files.names(f"{root.rstrip('/')}/_data").items():
        version = name.removeprefix(f"{VERSION}=")
        if version not in used and time.time() - changed >= min_age_s:
            files.delete(_profile_folder(root, version))
            gone += files.delete(_folder(root, version))
    for name in files.names(f"{root.rstrip('/')}/_profiles"):
        if name.endswith(".json") and name.partition("-")[0] in {f"{n:012d}" for n in numbers[:-keep]}:
            files.delete(f"{root.rstrip('/')}/_profiles/{name}")
    return gone
