"""The literacy pipeline: landing files to bronze, bronze to silver, silver to the gold star schema."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions import column, decode
from stratalake.operators import model
from stratalake.operators.clean import clean, clean_stored
from stratalake.plans import literacy_tables as tables
from stratalake.sources import (
    Written,
    accepted,
    decode_lines,
    event_lines,
    files_outside_log,
    land_csv,
    publish,
    read_csv,
    read_csv_text,
    read_parquet,
    write_parquet,
    write_partitioned,
)
from stratalake.sources.events import MISFIT, REASON, REFUSED_LINE, is_event
from stratalake.streaming.ingest import UNKNOWN_TYPE

# The bronze column that keeps lines whose values do not fit the declared types.
UNREADABLE = "_unreadable"


@dataclass(frozen=True)
class Layers:
    """Root folders of the layers."""

    bronze: str
    silver: str
    gold: str


# --- gold tables, as functions of silver tables -------------------------------------------------


def dim_uf(uf: DataFrame) -> DataFrame:
    return model.dimension(uf, "sigla_uf")


def dim_municipio(municipio: DataFrame, ts_municipio: DataFrame) -> DataFrame:
    return model.dimension_with_lookup(municipio, "id_municipio", ts_municipio, "sigla_uf")


def dim_tempo(municipio: DataFrame) -> DataFrame:
    return model.dimension(municipio, "ano")


def _yearly_targets(years) -> dict[str, str]:
    return {f"{tables.TARGET_PREFIX}{y}": f"{tables.TARGET_PREFIX}{y}" for y in years}


def fato_indicador(municipio: DataFrame, meta_por_municipio: DataFrame) -> DataFrame:
    """Realised value per municipality, year and network, with the municipal target where there is one."""
    labelled = municipio.withColumn(
        "rede", decode(F.col("rede"), tables.MUNICIPAL_NETWORKS, tables.UNCLASSIFIED)
    )
    return model.fact_vs_target(
        labelled,
        meta_por_municipio,
        keys=("id_municipio", "ano", "rede"),
        measures={"taxa_alfabetizacao": "taxa_realizada", "media_portugues": "media_portugues"},
        targets={
            "taxa_meta_referencia": "taxa_alfabetizacao",
            **_yearly_targets(tables.TARGET_YEARS),
            "nivel_alfabetizacao": "nivel_alfabetizacao",
            "percentual_participacao": "percentual_participacao",
        },
    )


def fato_indicador_uf(uf: DataFrame, meta_por_uf: DataFrame) -> DataFrame:
    """Realised value per state, year and network, with the state target where there is one."""
    labelled = uf.withColumn("rede", decode(F.col("rede"), tables.STATE_NETWORKS, tables.UNCLASSIFIED))
    last = f"{tables.TARGET_PREFIX}{tables.TARGET_YEARS[-1]}"
    return model.fact_vs_target(
        labelled,
        meta_por_uf,
        keys=("sigla_uf", "ano", "rede"),
        measures={"taxa_alfabetizacao": "taxa_realizada", "media_portugues": "media_portugues"},
        targets={
            "taxa_meta_referencia": "taxa_alfabetizacao",
            **_yearly_targets(tables.TARGET_YEARS[:-1]),
            last: column(last).try_cast("double"),
            "percentual_participacao": "percentual_participacao",
        },
    )


def fato_indicador_brasil(meta_brasil: DataFrame) -> DataFrame:
    return meta_brasil.dropDuplicates()


def fato_aluno_agregado(ts_aluno: DataFrame) -> DataFrame:
    """Results per municipality and year of the students who sat the test."""
    return model.aggregate_present(
        ts_aluno,
        flag="IN_PRESENCA_LP",
        keys={"CO_MUNICIPIO": "id_municipio", "NU_ANO_AVALIACAO": "ano"},
        mean_of={"VL_PROFICIENCIA_LP": "proficiencia_media"},
        percent_of={"IN_ALFABETIZADO": "percentual_alfabetizados"},
        count_of={"ID_ALUNO": "total_alunos_avaliados"},
    )


def state_regions(spark: SparkSession) -> DataFrame:
    """(sigla_uf, region) of the 27 states."""
    rows = [(state, region) for region, states in tables.REGION_STATES.items() for state in states]
    return spark.createDataFrame(rows, "sigla_uf string, region string")


# --- runs ---------------------------------------------------------------------------------------
# Each returns {table: rows written}; the rows are counted by the write job itself.


def _counted(name: str, written: Written) -> dict[str, int]:
    """Rows under the table's name, other counts under "table.count" where they are not 0."""
    return {name: written.rows, **{f"{name}.{what}": n for what, n in written.counts.items() if n}}


def run_bronze(spark: SparkSession, landing: str, layers: Layers, specs=tables.LANDED_BATCH) -> dict[str, int]:
    """Bring the landed CSV files into bronze, unchanged. Every text is read once.

    Tables with a declared schema get a column UNREADABLE with the whole line where a value does not fit it. If there are
    such rows, their number is returned as "table._unreadable". Other tables keep their text, and the write job finds the
    types; the types that the spec casts to are held at least.
    """
    written = {}
    for spec in specs:
        source, target = f"{landing}/{spec.file_name}", f"{layers.bronze}/{spec.name}"
        if spec.schema:
            raw = read_csv(spark, source, spec.separator, spec.schema, unreadable=UNREADABLE)
            made = publish(raw, target, counting={UNREADABLE: F.count(column(UNREADABLE))})
        else:
            made = publish(read_csv_text(spark, source, spec.separator), target, infer=True, at_least=spec.casts)
        written |= _counted(spec.name, made)
    return written


def run_landing(spark: SparkSession, delivered: str, path: str, specs=tables.LANDED_BATCH) -> dict[str, int]:
    """Land every delivered CSV file under the ingestion day, one folder per table; unreadable lines are counted as in bronze."""
    written = {}
    for spec in specs:
        made = land_csv(spark, f"{delivered}/{spec.file_name}", f"{path}/{spec.name}", spec.separator, spec.schema, spec.casts)
        written |= _counted(spec.name, made)
    return written


def run_bronze_events(
    spark: SparkSession, store: str, layers: Layers, outside_log: str = "error"
) -> dict[str, int]:
    """Decode the stored events of each type into a typed table, in one pass.

    Bronze keeps what cannot be decoded, with the reason and the line (see ``quarantine``); the number is returned as
    "table._refused", that of events with a value that does not fit as "table._changed", that of events of no known type as
    "unknown". The count of a table is that of its events.
    ``outside_log`` says what happens to files of a streamed store that its log does not name: "error" refuses
    them, "include" reads them as delivered by hand, "ignore" leaves them out as left by a failed attempt.
    """
    if outside_log not in ("error", "include", "ignore"):
        raise ValueError(f"outside_log: {outside_log!r}")
    outside = files_outside_log(spark, store) if outside_log == "error" else []
    if outside:
        raise ValueError(f"{len(outside)} files in {store} are not in the stream's log, such as {outside[0]}")
    written = {}
    for kind, spec in tables.EVENTS.items():
        lines = event_lines(spark, store, kind, committed_only=outside_log != "include")
        decoded = decode_lines(lines, spec.schema)
        counting = {REASON: F.count_if(~is_event()), "_changed": F.count_if(column(REASON) == MISFIT)}
        made = publish(decoded, f"{layers.bronze}/{spec.name}", counting=counting)
        written |= _counted(spec.name, replace(made, rows=made.rows - made.counts[REASON]))
    unknown = event_lines(spark, store, UNKNOWN_TYPE, committed_only=outside_log != "include").count()
    return written | ({UNKNOWN_TYPE: unknown} if unknown else {})


def quarantine(spark: SparkSession, layers: Layers) -> DataFrame:
    """(table, reason, line) of the stored events that bronze refused, or kept with a value less."""
    found = [
        read_parquet(spark, f"{layers.bronze}/{spec.name}").where(column(REASON).isNotNull())
        .select(F.lit(spec.name).alias("table"), column(REASON).alias("reason"), column(REFUSED_LINE).alias("line"))
        for spec in tables.EVENTS.values()
    ]
    return reduce(DataFrame.unionByName, found)


def run_silver(spark: SparkSession, layers: Layers, specs=(*tables.CLEANED_BATCH, tables.TS_ALUNO)) -> dict[str, int]:
    """Clean bronze tables, wide ones by digests. Pass the specs of ``literacy_tables.EVENTS`` to clean events."""
    written = {}
    for spec in specs:
        raw = read_parquet(spark, f"{layers.bronze}/{spec.name}").drop(UNREADABLE)
        raw = accepted(raw) if REASON in raw.columns else raw
        cleaned = clean_stored(raw, spec) if spec.wide else clean(raw, spec)
        written[spec.name] = write_parquet(cleaned, f"{layers.silver}/{spec.name}")
    return written


def run_gold(spark: SparkSession, layers: Layers) -> dict[str, int]:
    """Build the star schema whole. The municipal fact is partitioned by year. ``changed_years`` rebuilds changed years only."""

    def silver(spec):
        return read_parquet(spark, f"{layers.silver}/{spec.name}")

    uf, municipio = silver(tables.UF), silver(tables.MUNICIPIO)
    plain = {
        "dim_uf": dim_uf(uf),
        "dim_municipio": dim_municipio(municipio, silver(tables.TS_MUNICIPIO)),
        "dim_tempo": dim_tempo(municipio),
        "fato_indicador_uf": fato_indicador_uf(uf, silver(tables.META_POR_UF)),
        "fato_indicador_brasil": fato_indicador_brasil(silver(tables.META_BRASIL)),
        "fato_aluno_agregado": fato_aluno_agregado(silver(tables.TS_ALUNO)),
    }
    written = {name: write_parquet(df, f"{layers.gold}/{name}") for name, df in plain.items()}
    fact = fato_indicador(municipio, silver(tables.META_POR_MUNICIPIO))
    written["fato_indicador"] = write_partitioned(fact, f"{layers.gold}/fato_indicador", "ano", whole=True)
    return written
