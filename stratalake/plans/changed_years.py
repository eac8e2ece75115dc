"""Facts rebuilt for the years whose silver rows changed. The files of all other years stay as they are."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions import column
from stratalake.operators.distinct import row_digests
from stratalake.plans import literacy
from stratalake.plans import literacy_tables as tables
from stratalake.sources.published import publish, snapshot
from stratalake.sources.readers import read_parquet
from stratalake.sources.writers import write_parquet


@dataclass(frozen=True)
class Source:
    """A stored table that a fact is built from: its column of the year, and the columns the fact needs (all, if not given)."""

    table: DataFrame
    year: str
    columns: Sequence[str] = ()

    def needed(self) -> DataFrame:
        return self.table.select(*map(column, self.columns or self.table.columns))


@dataclass(frozen=True)
class Rebuilt:
    """What an update did: rows written, years built anew, and years that are gone. None is the year NULL."""

    rows: int
    built: tuple
    removed: tuple


def fingerprints(source: Source) -> DataFrame:
    """(year, fingerprint) of every year: row count and the sums of two 64-bit hashes of its rows, whatever their order.

    Sums and counts are combined inside each map task, so a year that holds most rows is one row per task in the shuffle.
    """
    needed = source.needed()
    first, second = row_digests(needed)
    # The sums of 64-bit numbers are exact as decimals.
    totals = [F.sum(h.cast("decimal(20,0)")).cast("string") for h in (first, second)]
    print_of = F.concat_ws(":", F.count(F.lit(1)).cast("string"), *totals)
    return needed.groupBy(column(source.year).alias("year")).agg(print_of.alias("fingerprint"))


def _found(sources: Mapping[str, Source]) -> dict[str, dict[str, str]]:
    """{year as text: {source: fingerprint}}; "" is the year NULL. A few rows per year come to the driver."""
    frames = [
        fingerprints(s).select(F.lit(name).alias("source"), F.col("year").cast("string").alias("year"), "fingerprint")
        for name, s in sources.items()
    ]
    found: dict[str, dict[str, str]] = {}
    for r in reduce(DataFrame.unionByName, frames).collect():
        found.setdefault(r["year"] or "", {})[r["source"]] = r["fingerprint"]
    return found


def update_by_year(
    spark: SparkSession,
    root: str,
    year: str,
    sources: Mapping[str, Source],
    build: Callable[..., DataFrame],
    definition: str = "1",
) -> Rebuilt:
    """Bring the fact published at ``root``, partitioned by whole-number ``year``, up to date with its sources.

    ``build`` takes the sources' tables by name; a row of its result must come from rows of its own year alone. The manifest keeps the
    fingerprint of every year in every source. Years that have another one now are built from their own rows only, years that
    left all sources go, both with one manifest: an update that ends half way changes nothing. Without a change nothing is
    written. Another ``definition``, or a table stored in another way, builds all years. If the table was published by
    somebody else meanwhile, ``Conflict`` is raised.
    """
    state = snapshot(spark, root)
    found = _found(sources)
    notes = {"years": found, "definition": definition}
    fit = state is not None and state.partition_by == (year,) and state.notes.get("definition") == definition
    before = state.notes["years"] if fit else {}
    built = [y for y in found if found[y] != before.get(y)]
    gone = [y for y in before if y not in found]
    if fit and not built and not gone:
        return Rebuilt(0, (), ())

    def chosen(s: Source) -> DataFrame:
        if not fit:
            return s.needed()
        of_year = column(s.year)
        known = of_year.isin([int(y) for y in built if y])
        return s.needed().where(known | of_year.isNull() if "" in built else known)

    fact = build(**{name: chosen(s) for name, s in sources.items()})
    folders = [f"{year}={y or '__HIVE_DEFAULT_PARTITION__'}" for y in (*built, *gone)]
    how = {"how": "partitions", "without": folders} if fit else {"how": "table"}
    rows = publish(fact, root, year, notes=notes, after=state.number if state else 0, **how).rows
    as_years = lambda texts: tuple(int(y) if y else None for y in sorted(texts))
    return Rebuilt(rows, as_years(built), as_years(gone))


def update_gold(spark: SparkSession, layers: literacy.Layers) -> dict[str, Rebuilt | int]:
    """The star schema from silver: facts by changed years, the small dimensions and the national fact whole."""

    def silver(spec):
        return read_parquet(spark, f"{layers.silver}/{spec.name}")

    uf, municipio, student = silver(tables.UF), silver(tables.MUNICIPIO), silver(tables.TS_ALUNO)
    small = {
        "dim_uf": literacy.dim_uf(uf),
        "dim_municipio": literacy.dim_municipio(municipio, silver(tables.TS_MUNICIPIO)),
        "dim_tempo": literacy.dim_tempo(municipio),
        "fato_indicador_brasil": literacy.fato_indicador_brasil(silver(tables.META_BRASIL)),
    }
    written = {name: write_parquet(df, f"{layers.gold}/{name}") for name, df in small.items()}
    of_student = (
        "CO_MUNICIPIO", "NU_ANO_AVALIACAO", "IN_PRESENCA_LP", "VL_PROFICIENCIA_LP", "IN_ALFABETIZADO", "ID_ALUNO",
    )
    facts = {
        "fato_indicador": (
            {"municipio": Source(municipio, "ano"), "meta_por_municipio": Source(silver(tables.META_POR_MUNICIPIO), "ano")},
            literacy.fato_indicador,
        ),
        "fato_indicador_uf": (
            {"uf": Source(uf, "ano"), "meta_por_uf": Source(silver(tables.META_POR_UF), "ano")},
            literacy.fato_indicador_uf,
        ),
        "fato_aluno_agregado": (
            {"ts_aluno": Source(student, "NU_ANO_AVALIACAO", of_student)},
            literacy.fato_aluno_agregado,
        ),
    }
    for name, (sources, build) in facts.items():
        written[name] = update_by_year(spark, f"{layers.gold}/{name}", "ano", sources, build)
    return written
