"""Monitoring of stored tables: one report row per finding, with latency and severity."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions import column
from stratalake.operators import quality
from stratalake.operators.clean import require_columns
from stratalake.plans import literacy_tables as tables
from stratalake.sources import read_parquet, read_table, snapshot, table_profile
from stratalake.sources.published import kept_result

REPORT_SCHEMA = (
    "dataset string, check string, subject string, value bigint, severity string, elapsed_s double, message string"
)


@dataclass(frozen=True)
class Relation:
    """A table whose keys a watched table should find. Pairs name keys that are called differently on the two sides.

    With ``unique`` keys that the reference holds several times are a finding too: a join would multiply rows.
    """

    read: Callable[[], DataFrame]
    keys: Sequence[str | tuple[str, str]]
    unique: bool = False


@dataclass(frozen=True)
class Watch:
    """A table to monitor: how to read it, its business key and the columns whose NULLs matter.

    ``relations`` are checked under their labels, ``whole_rows`` asks for rows that are equal in all columns. ``stored`` is the folder of a
    published table that ``read`` gives unchanged: volume and NULLs then come from its profiles, and what is found about copies is
    kept with the published state, so that a table nobody wrote to is not scanned again.
    """

    read: Callable[[], DataFrame]
    business_key: Sequence[str] = ()
    critical_columns: Sequence[str] | None = None
    relations: Mapping[str, Relation] = field(default_factory=dict)
    whole_rows: bool = False
    stored: str | None = None


def _row(check: str, subject: str, value: Column) -> Column:
    return F.struct(F.lit(check).alias("check"), F.lit(subject).alias("subject"), value.cast("bigint").alias("value"))


def _copies(df: DataFrame, watch: Watch) -> list[DataFrame]:
    """Duplicate keys and copies of whole rows, each a scan."""
    checks = []
    if watch.business_key:
        measures = [_row("duplicates", name, F.col(name)) for name in ("duplicate_groups", "surplus_rows")]
        duplicates = quality.duplicate_keys(df, watch.business_key)
        checks.append(duplicates.select(F.inline(F.array(*measures))))
    if watch.whole_rows:
        copies = quality.duplicate_keys(df, df.columns)
        checks.append(copies.select(F.inline(F.array(_row("row_copies", "surplus_rows", F.col("surplus_rows"))))))
    return checks


def stored_findings(spark: SparkSession, watch: Watch) -> DataFrame:
    """``findings`` of the published table at ``watch.stored``, scanning only what is not known of its last state."""
    state = snapshot(spark, watch.stored)
    if state is None:
        raise FileNotFoundError(f"nothing is published in {watch.stored}")
    names = list(watch.critical_columns or state.schema().names)
    require_columns(spark.createDataFrame([], state.schema()), names, "findings")
    profile = table_profile(spark, watch.stored, state.number)
    total = profile.agg(F.coalesce(F.max("row_count"), F.lit(0)).alias("n")).select(F.inline(F.array(_row("volume", "rows", F.col("n")))))
    nulls = profile.where(column("column_name").isin(names)).select(F.lit("nulls").alias("check"), F.col("column_name").alias("subject"), F.col("null_count").alias("value"))
    asked = json.dumps([list(watch.business_key), watch.whole_rows])

    def counted() -> list:
        df = read_table(spark, watch.stored, state.number)
        return [list(r) for part in _copies(df, watch) for r in part.collect()]

    copies = kept_result(spark, watch.stored, state.number, hashlib.sha256(asked.encode()).hexdigest()[:16], counted)
    return total.union(nulls).union(spark.createDataFrame([tuple(r) for r in copies], "check string, subject string, value bigint"))


def findings(df: DataFrame, watch: Watch) -> DataFrame:
    """(check, subject, value) rows of volume, NULL counts and duplicates, as one Spark job.

    Volume and NULL counts come from one scan, duplicate keys from a second one, copies of whole rows from a third.
    """
    names = list(watch.critical_columns or df.columns)
    require_columns(df, names, "findings")
    every = F.count(F.lit(1))
    counted = [_row("volume", "rows", every), *[_row("nulls", n, every - F.count(column(n))) for n in names]]
    checks = [df.agg(F.array(*counted).alias("found")).select(F.inline("found"))]
    return reduce(DataFrame.unionByName, [*checks, *_copies(df, watch)])


def relation_findings(df: DataFrame, label: str, relation: Relation) -> DataFrame:
    """Rows of ``df`` whose key the reference lacks and, if asked for, surplus rows of the reference's keys."""
    reference = relation.read()
    orphans = quality.orphan_summary(df, reference, relation.keys)
    checks = [orphans.select(F.inline(F.array(_row("orphans", label, F.col("orphan_rows")))))]
    if relation.unique:
        keys = [k if isinstance(k, str) else k[1] for k in relation.keys]
        repeats = quality.duplicate_keys(reference, keys)
        checks.append(repeats.select(F.inline(F.array(_row("reference_repeats", label, F.col("surplus_rows"))))))
    return reduce(DataFrame.unionByName, checks)


def _severity(check: str, value: int) -> str:
    wanted = value > 0 if check == "volume" else value == 0
    return "ok" if wanted else "alert"


def _message(error: Exception) -> str:
    """The error's type and the first line of its text, if it has any."""
    return ": ".join([type(error).__name__, *str(error).strip().splitlines()[:1]])


def monitor(
    spark: SparkSession, watches: Mapping[str, Watch], fail_fast: bool = False, at_once: int = 4
) -> DataFrame:
    """Report over all tables. A table or relation that cannot be read or scanned gives one ``read_failed`` row.

    With ``fail_fast`` the error is raised instead. Reading and checking of a table run inside one guarded
    block, because Spark touches the files only when the job runs; so does each of its relations, whose label is
    the subject of its failure. ``at_once`` such jobs run side by side. Only the findings, a few rows per table, come to
    the driver. ``elapsed_s`` is the time of the row's job; the last row is the total.
    """
    began = time.monotonic()
    jobs = []
    for name, watch in watches.items():
        jobs.append((name, None, lambda w=watch: stored_findings(spark, w) if w.stored else findings(w.read(), w)))
        for label, relation in watch.relations.items():
            jobs.append((name, label, lambda w=watch, n=label, r=relation: relation_findings(w.read(), n, r)))

    def checked(job) -> list[tuple]:
        name, label, make = job
        started = time.monotonic()
        try:
            found = make().collect()
        except Exception as error:
            if fail_fast:
                raise
            return [(name, "read_failed", label, None, "alert", time.monotonic() - started, _message(error))]
        elapsed = time.monotonic() - started
        return [
            (name, r["check"], r["subject"], r["value"], _severity(r["check"], r["value"]), elapsed, None)
            for r in found
        ]

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        rows = [row for part in pool.map(inheritable_thread_target(spark)(checked), jobs) for row in part]
    rows.append(("total", "latency", None, None, "ok", time.monotonic() - began, None))
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def literacy_watches(spark: SparkSession, silver: str) -> dict[str, Watch]:
    """The cleaned literacy tables; of the microdata only the critical columns are profiled."""
    def reader(name):
        return lambda: read_parquet(spark, f"{silver}/{name}")

    def targets(name, *keys):
        return {name: Relation(reader(name), keys)}

    related = {
        "uf": targets("meta_por_uf", "ano", "sigla_uf"),
        "municipio": targets("meta_por_municipio", "ano", "id_municipio"),
    }
    watches = {
        s.name: Watch(reader(s.name), s.business_key, relations=related.get(s.name, {}), whole_rows=True)
        for s in tables.CLEANED_BATCH
    }
    student = tables.TS_ALUNO
    known = {"municipio": Relation(reader("municipio"), [("CO_MUNICIPIO", "id_municipio")])}
    watches[student.name] = Watch(
        reader(student.name), student.business_key, tables.STUDENT_CRITICAL_COLUMNS, relations=known
    )
    return watches


def relations(table: Callable[[str], DataFrame], checked: Mapping[str, tuple[str, str, Sequence]]) -> DataFrame:
    """(relation, orphan_keys, orphan_rows, has_orphans) of every (table, reference table, keys)."""
    summaries = [
        quality.orphan_summary(table(left), table(right), keys).select(F.lit(label).alias("relation"), "*")
        for label, (left, right, keys) in checked.items()
    ]
    return reduce(DataFrame.unionByName, summaries)


def literacy_relations(spark: SparkSession, silver: str) -> DataFrame:
    """Realised rows without a target of their state or municipality, students of unknown municipalities."""
    checked = {
        "uf x meta_por_uf": ("uf", "meta_por_uf", ["ano", "sigla_uf"]),
        "municipio x meta_por_municipio": ("municipio", "meta_por_municipio", ["ano", "id_municipio"]),
        "ts_aluno x municipio": ("ts_aluno", "municipio", [("CO_MUNICIPIO", "id_municipio")]),
    }
    return relations(lambda name: read_parquet(spark, f"{silver}/{name}"), checked)


def star_relations(spark: SparkSession, gold: str) -> DataFrame:
    """Fact keys that the dimensions lack."""
    checked = {
        "fato_indicador x dim_municipio": ("fato_indicador", "dim_municipio", ["id_municipio"]),
        "fato_indicador x dim_tempo": ("fato_indicador", "dim_tempo", ["ano"]),
        "fato_indicador_uf x dim_uf": ("fato_indicador_uf", "dim_uf", ["sigla_uf"]),
        "fato_aluno_agregado x dim_municipio": ("fato_aluno_agregado", "dim_municipio", ["id_municipio"]),
    }
    return relations(lambda name: read_parquet(spark, f"{gold}/{name}"), checked)
