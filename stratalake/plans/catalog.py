"""Every registered query: (session, data folder) to DataFrame, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions import column
from stratalake.operators import quality, report
from stratalake.operators.clean import clean, clean_stored, presence_split
from stratalake.plans import changed_years, history, incremental, literacy, monitoring, standin
from stratalake.plans import literacy_tables as tables
from stratalake.session import work_folder
from stratalake.sources import (
    decode_events,
    decode_lines,
    event_lines,
    land_csv,
    publish,
    read_csv,
    read_csv_text,
    read_events,
    read_parquet,
    retire,
    table_profile,
    write_parquet,
    write_partitioned,
)
from stratalake.sources.events import REASON
from stratalake.streaming import envelope, merge_events, remove_merged_files, start_ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CLEANED = {spec.name: spec for spec in (*tables.CLEANED_BATCH, tables.TS_ALUNO)}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def silver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return clean(standin.raw(spark, sf_dir, name), CLEANED[name])


def _written_csv(spark: SparkSession, df: DataFrame, label: str, separator: str = ",") -> str:
    """Folder with ``df`` as CSV, values as they are: the writer would strip blanks around them."""
    path = work_folder(spark, label)
    keep_blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.options(header=True, sep=separator, **keep_blanks).csv(path)
    return path


# --- sources and sinks ----------------------------------------------------------------------------


@query
def bronze_csv_inferred(spark, sf_dir):
    """Comma CSV to bronze and back: the text is read once, and the write job finds the types."""
    spec = tables.MUNICIPIO
    path = _written_csv(spark, standin.raw(spark, sf_dir, "municipio"), "csv")
    bronze = work_folder(spark, "bronze")
    publish(read_csv_text(spark, path), bronze, infer=True, at_least=spec.casts)
    return read_parquet(spark, bronze)


@query
def bronze_csv_semicolon(spark, sf_dir):
    """Semicolon CSV to bronze and back, types as above."""
    spec = tables.TS_ITEM
    path = _written_csv(spark, standin.raw(spark, sf_dir, "ts_item"), "csv", spec.separator)
    bronze = work_folder(spark, "bronze")
    publish(read_csv_text(spark, path, spec.separator), bronze, infer=True, at_least=spec.casts)
    return read_parquet(spark, bronze)


@query
def bronze_csv_explicit(spark, sf_dir):
    """Semicolon CSV of the microdata with its declared schema to bronze and back; bronze keeps unreadable lines, here none."""
    spec = tables.TS_ALUNO
    path = _written_csv(spark, standin.raw(spark, sf_dir, "ts_aluno"), "csv", spec.separator)
    bronze = work_folder(spark, "bronze")
    write_parquet(read_csv(spark, path, spec.separator, spec.schema, unreadable=literacy.UNREADABLE), bronze)
    return read_parquet(spark, bronze).where(column(literacy.UNREADABLE).isNull()).drop(literacy.UNREADABLE)


@query
def bronze_csv_unreadable(spark, sf_dir):
    """Realised rates under a schema that some codes do not fit: rows by network, and the lines kept of those that do not."""
    spec = tables.MUNICIPIO
    raw = standin.raw(spark, sf_dir, "municipio")
    declared = T.StructType([T.StructField(n, spec.casts.get(n, T.StringType())) for n in raw.columns])
    bronze = work_folder(spark, "bronze")
    write_parquet(read_csv(spark, _written_csv(spark, raw, "csv"), schema=declared, unreadable=literacy.UNREADABLE), bronze)
    kept = column(literacy.UNREADABLE)
    return read_parquet(spark, bronze).groupBy("rede", "serie").agg(
        F.count(F.lit(1)).alias("n"), F.count(kept).alias("unreadable"), F.count_if(kept.contains("n/d")).alias("without_series"), F.count_if(kept.contains("Estadual")).alias("named_network"),
    )


@query
def bronze_csv_variants(spark, sf_dir):
    """A folder whose files have three headers (whole, in another order, one column less), landed by names and read back."""
    raw = standin.raw(spark, sf_dir, "municipio")
    series = F.coalesce("serie", F.lit(""))
    folder = work_folder(spark, "csv")
    keep_blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    for part in (
        raw.where(series == "2"),
        raw.where(series == "n/d").select(*reversed(raw.columns)),
        raw.where(~series.isin("2", "n/d")).drop("media_portugues"),
    ):
        part.write.mode("append").options(header=True, **keep_blanks).csv(folder)
    landed = work_folder(spark, "landed")
    land_csv(spark, folder, landed, at_least=tables.MUNICIPIO.casts, variants=True)
    return read_parquet(spark, landed).select(*raw.columns)


@query
def bronze_csv_quoted(spark, sf_dir):
    """CSV of whole texts, with quotes, separators and line breaks in them, to bronze Parquet and back."""
    docs = standin.table(spark, sf_dir, "documents").select("doc_id", "text")
    path = work_folder(spark, "csv")
    keep_blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    docs.write.options(header=True, escape='"', quoteAll=True, nullValue="", emptyValue='""', **keep_blanks).csv(path)
    bronze = work_folder(spark, "bronze")
    write_parquet(read_csv(spark, path, schema=docs.schema, multi_line=True), bronze)
    return read_parquet(spark, bronze, docs.schema)


@query
def bronze_json_events(spark, sf_dir):
    """Flat JSON lines per event type to a typed bronze table and back."""
    spec = tables.DADOS_ALUNO
    stored = envelope(standin.event_payloads(standin.table(spark, sf_dir, "events")))
    store = work_folder(spark, "events")
    stored.select(column("_raw_data").alias("value"), "tipo_mensagem").write.partitionBy("tipo_mensagem").text(store)
    bronze = work_folder(spark, "bronze")
    write_parquet(read_events(spark, store, "dados_aluno", spec.schema), bronze)
    return read_parquet(spark, bronze, spec.schema)


@query
def event_quarantine(spark, sf_dir):
    """Stored lines of every type, some damaged: how many are good and how many are refused or changed for which reason."""
    store = work_folder(spark, "events")
    standin.damaged_lines(standin.table(spark, sf_dir, "events")).write.partitionBy("tipo_mensagem").text(store)
    decoded = [
        decode_lines(event_lines(spark, store, kind), spec.schema).select(F.lit(kind).alias("tipo_mensagem"), F.coalesce(REASON, F.lit("ok")).alias("reason"))
        for kind, spec in tables.EVENTS.items()
    ]
    return reduce(DataFrame.unionByName, decoded).groupBy("tipo_mensagem", "reason").agg(F.count(F.lit(1)).alias("events"))


@query
def table_published(spark, sf_dir):
    """The municipal fact published by year, one year replaced by half its rates, and rows of another year appended."""
    path = work_folder(spark, "gold")
    fact = fact_entity_target(spark, sf_dir).select("id_municipio", "ano", "rede", "taxa_realizada")
    write_partitioned(fact, path, "ano")
    halved = read_parquet(spark, path).where(F.col("ano") == 2027).withColumn("taxa_realizada", F.col("taxa_realizada") / 2)
    write_partitioned(halved, path, "ano")
    late = read_parquet(spark, path).where(F.col("ano") == 2026).withColumn("ano", F.lit(2099))
    publish(late, path, "ano", how="append")
    retire(spark, path, keep=1, min_age_s=0)
    return read_parquet(spark, path)


@query
def batch_landing_partitioned(spark, sf_dir):
    """A folder of CSV files landed under the ingestion day, read back without the day."""
    raw = standin.raw(spark, sf_dir, "meta_por_municipio")
    landed = work_folder(spark, "landed")
    land_csv(spark, _written_csv(spark, raw, "csv"), landed, at_least=tables.META_POR_MUNICIPIO.casts)
    return read_parquet(spark, landed).select(*raw.columns)


# --- silver ---------------------------------------------------------------------------------------


@query
def silver_clean_state(spark, sf_dir):
    return silver(spark, sf_dir, "uf")


@query
def silver_clean_entity(spark, sf_dir):
    return silver(spark, sf_dir, "municipio")


@query
def silver_target_national(spark, sf_dir):
    return silver(spark, sf_dir, "meta_brasil")


@query
def silver_target_state(spark, sf_dir):
    return silver(spark, sf_dir, "meta_por_uf")


@query
def silver_target_entity(spark, sf_dir):
    return silver(spark, sf_dir, "meta_por_municipio")


@query
def silver_clean_renamed(spark, sf_dir):
    return silver(spark, sf_dir, "ts_municipio")


@query
def silver_clean_renamed_state(spark, sf_dir):
    return silver(spark, sf_dir, "ts_estado")


@query
def silver_student(spark, sf_dir):
    return silver(spark, sf_dir, "ts_aluno")


@query
def silver_student_digests(spark, sf_dir):
    """The stored microdata cleaned with duplicates found by digests; some of the rows are there twice."""
    bronze = work_folder(spark, "bronze")
    write_parquet(standin.raw(spark, sf_dir, "ts_aluno"), bronze)
    return clean_stored(read_parquet(spark, bronze), tables.TS_ALUNO)


@query
def presence_counts(spark, sf_dir):
    return presence_split(silver(spark, sf_dir, "ts_aluno"), "IN_PRESENCA_LP")


def _silver_event(spark, sf_dir, kind):
    spec = tables.EVENTS[kind]
    stored = envelope(standin.event_payloads(standin.table(spark, sf_dir, "events")))
    return clean(decode_events(stored.where(F.col("tipo_mensagem") == kind), spec.schema), spec)


@query
def silver_event_student(spark, sf_dir):
    return _silver_event(spark, sf_dir, "dados_aluno")


@query
def silver_event_entity(spark, sf_dir):
    return _silver_event(spark, sf_dir, "dados_municipio")


@query
def silver_event_indicator(spark, sf_dir):
    return _silver_event(spark, sf_dir, "dados_indicadores")


@query
def silver_event_item(spark, sf_dir):
    return _silver_event(spark, sf_dir, "dados_itens")


# --- gold -----------------------------------------------------------------------------------------


@query
def dim_state(spark, sf_dir):
    return literacy.dim_uf(silver(spark, sf_dir, "uf"))


@query
def dim_entity(spark, sf_dir):
    return literacy.dim_municipio(silver(spark, sf_dir, "municipio"), silver(spark, sf_dir, "ts_municipio"))


@query
def dim_time(spark, sf_dir):
    return literacy.dim_tempo(silver(spark, sf_dir, "municipio"))


@query
def fact_entity_target(spark, sf_dir):
    return literacy.fato_indicador(silver(spark, sf_dir, "municipio"), silver(spark, sf_dir, "meta_por_municipio"))


@query
def fact_state_target(spark, sf_dir):
    return literacy.fato_indicador_uf(silver(spark, sf_dir, "uf"), silver(spark, sf_dir, "meta_por_uf"))


@query
def fact_national(spark, sf_dir):
    return literacy.fato_indicador_brasil(silver(spark, sf_dir, "meta_brasil"))


@query
def fact_student_aggregate(spark, sf_dir):
    return literacy.fato_aluno_agregado(silver(spark, sf_dir, "ts_aluno"))


def _stored_fact(spark, sf_dir):
    """The municipal fact, written by year and read back."""
    path = work_folder(spark, "gold")
    write_partitioned(fact_entity_target(spark, sf_dir), path, "ano")
    return read_parquet(spark, path)


@query
def fact_year_pruned(spark, sf_dir):
    """Reading one year of the stored fact touches that year's folder only."""
    return _stored_fact(spark, sf_dir).where(F.col("ano") == 2027)


@query
def fact_years_updated(spark, sf_dir):
    """The municipal fact built without 2026, then updated: 2026 has come, 2025 has left, the rates of 2027 are halved."""
    stored = {}
    for name in ("municipio", "meta_por_municipio"):
        path = work_folder(spark, name)
        write_parquet(silver(spark, sf_dir, name), path)
        stored[name] = read_parquet(spark, path)
    root, year, rate = work_folder(spark, "gold"), column("ano"), column("taxa_alfabetizacao")
    halved = stored["municipio"].withColumn("taxa_alfabetizacao", F.when(year == 2027, rate / 2).otherwise(rate))
    for rows, missing in ((stored["municipio"], 2026), (halved, 2025)):
        left = {"municipio": rows, "meta_por_municipio": stored["meta_por_municipio"]}
        sources = {n: changed_years.Source(t.where(~year.eqNullSafe(missing)), "ano") for n, t in left.items()}
        changed_years.update_by_year(spark, root, "ano", sources, literacy.fato_indicador)
    return read_parquet(spark, root)


# --- data quality ---------------------------------------------------------------------------------


@query
def dq_null_profile(spark, sf_dir):
    return quality.null_profile(standin.raw(spark, sf_dir, "ts_aluno"))


@query
def dq_critical_nulls(spark, sf_dir):
    return quality.null_profile(silver(spark, sf_dir, "ts_aluno"), tables.STUDENT_CRITICAL_COLUMNS)


@query
def dq_duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(standin.raw(spark, sf_dir, "ts_aluno"), tables.TS_ALUNO.business_key)


@query
def dq_duplicate_line_keys(spark, sf_dir):
    return quality.duplicate_keys(standin.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dq_duplicate_rows(spark, sf_dir):
    raw = standin.raw(spark, sf_dir, "municipio")
    return quality.duplicate_keys(raw, raw.columns)


@query
def dq_fact_grain(spark, sf_dir):
    """Whether the municipal fact holds one row per municipality, year and network.

    It is checked as stored. Right above the join Spark would count on the join's own partitioning, and a
    hot key would stay in one task; from the scan its rows are combined before the shuffle.
    """
    return quality.duplicate_keys(_stored_fact(spark, sf_dir), ["id_municipio", "ano", "rede"])


@query
def dq_orphans_same_key(spark, sf_dir):
    return quality.orphans(
        silver(spark, sf_dir, "uf"), silver(spark, sf_dir, "meta_por_uf"), ["ano", "sigla_uf"]
    )


@query
def dq_orphans_entity_target(spark, sf_dir):
    return quality.orphan_summary(
        silver(spark, sf_dir, "municipio"),
        silver(spark, sf_dir, "meta_por_municipio"),
        ["ano", "id_municipio"],
    )


@query
def dq_orphans_renamed_key(spark, sf_dir):
    """Municipalities of the microdata that the municipality table lacks."""
    return quality.orphans(
        silver(spark, sf_dir, "ts_aluno"),
        silver(spark, sf_dir, "municipio"),
        [("CO_MUNICIPIO", "id_municipio")],
    )


@query
def dq_orphans_null_key(spark, sf_dir):
    """Raw municipality rows against raw targets: rows without a code match nothing and are orphans."""
    return quality.orphans(
        standin.raw(spark, sf_dir, "municipio"), standin.raw(spark, sf_dir, "meta_por_municipio"), ["id_municipio"]
    )


@query
def dq_orphans_fact_dimension(spark, sf_dir):
    """Whether every municipality of the fact is in the dimension."""
    return quality.orphan_summary(
        fact_entity_target(spark, sf_dir), dim_entity(spark, sf_dir), ["id_municipio"]
    )


@query
def dq_monitor_report(spark, sf_dir):
    """The monitoring report of three given tables and of one that is not there, without the times."""
    keys = {
        "customer": ["c_custkey"],
        "orders": ["o_custkey", "o_orderdate"],
        "lineitem": ["l_orderkey", "l_linenumber"],
        "absent": ["key"],
    }
    watches = {
        name: monitoring.Watch(lambda name=name: standin.table(spark, sf_dir, name), key)
        for name, key in keys.items()
    }
    customer = monitoring.Relation(watches["customer"].read, [("o_custkey", "c_custkey")], unique=True)
    watches["orders"] = replace(watches["orders"], relations={"customer": customer}, whole_rows=True)
    return monitoring.monitor(spark, watches).drop("elapsed_s", "message")


@query
def dq_volume(spark, sf_dir):
    return reduce(
        DataFrame.unionByName,
        [
            quality.volume(standin.raw(spark, sf_dir, name)).select(F.lit(name).alias("dataset"), "*")
            for name in standin.RAW_SQL
        ],
    )


@query
def dq_profile_kept(spark, sf_dir):
    """Orders published by status with profiles, one status replaced, later orders appended without a profile: the merged profile."""
    orders = standin.table(spark, sf_dir, "orders")
    root = work_folder(spark, "profiled")
    publish(orders, root, "o_orderstatus", profile=True)
    changed = read_parquet(spark, root).where(F.col("o_orderstatus") == "F")
    changed = changed.withColumn("o_custkey", F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_custkey")))
    publish(changed, root, "o_orderstatus", how="partitions", profile=True)
    late = orders.withColumns({"o_orderkey": -F.col("o_orderkey"), "o_orderstatus": F.lit("later")}).where(F.col("o_orderpriority") == "5-LOW")
    publish(late, root, "o_orderstatus", how="append")
    return table_profile(spark, root)


@query
def dq_monitor_stored(spark, sf_dir):
    """The monitoring report of line items as published, from the profile of the write and the kept count of copies, without the times."""
    root = work_folder(spark, "watched")
    publish(standin.table(spark, sf_dir, "lineitem"), root, profile=True)
    watch = monitoring.Watch(lambda: read_parquet(spark, root), ["l_orderkey", "l_linenumber"], stored=root)
    monitoring.monitor(spark, {"lineitem": watch})
    return monitoring.monitor(spark, {"lineitem": watch}).drop("elapsed_s", "message")


@query
def dq_volume_history(spark, sf_dir):
    """Orders a month and priority as volumes of kept runs, tripled for one priority in July, against earlier months."""
    orders = standin.table(spark, sf_dir, "orders")
    month = F.trunc("o_orderdate", "month")
    volumes = orders.groupBy(F.col("o_orderpriority").alias("dataset"), month.alias("month")).agg(F.count(F.lit(1)).alias("n"))
    planted = (F.month("month") == 7) & (F.col("dataset") == "1-URGENT")
    found = volumes.select(
        "dataset", F.lit("volume").alias("check"), F.lit("rows").alias("subject"), F.when(planted, F.col("n") * 3).otherwise(F.col("n")).alias("value"),
        F.lit("ok").alias("severity"), F.lit(1.0).alias("elapsed_s"), F.lit(None).cast("string").alias("message"),
        F.col("month").cast("string").alias("run"), F.col("month").cast("timestamp").alias("at"),
    )
    root = work_folder(spark, "findings")
    publish(found, root, how="append")
    return history.judge(history.kept_findings(spark, root)).select("dataset", "run", "value", "usual_value", "severity", "message")


@query
def dq_cleaning_effect(spark, sf_dir):
    """Rows of every cleaned table before and after cleaning."""
    return reduce(
        DataFrame.unionByName,
        [
            quality.cleaning_effect(standin.raw(spark, sf_dir, name), spec).select(F.lit(name).alias("dataset"), "*")
            for name, spec in CLEANED.items()
        ],
    )


@query
def dq_fact_profile(spark, sf_dir):
    return quality.fact_profile(fact_entity_target(spark, sf_dir), "id_municipio", "taxa_realizada", "ano")


# --- events and streaming -------------------------------------------------------------------------


@query
def event_json_route(spark, sf_dir):
    stored = envelope(standin.event_payloads(standin.table(spark, sf_dir, "events")))
    return stored.groupBy("tipo_mensagem").agg(F.count(F.lit(1)).alias("events"))


def _ingested_store(spark: SparkSession, sf_dir: str) -> str:
    """The given events streamed into an event store, until all are in."""
    source = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(source).schema
    # As a pattern the source may be one file or a folder of files; a plain path must be a folder.
    pattern = f"{sf_dir}/{{events.parquet}}"
    stream = standin.event_payloads(spark.readStream.schema(schema).parquet(pattern))
    store = work_folder(spark, "store")
    running = start_ingest(stream, store, work_folder(spark, "checkpoint"), trigger={"availableNow": True})
    running.awaitTermination()
    return store


@query
def event_stream_ingest(spark, sf_dir):
    """Events streamed into the store and read back: type and event time of each."""
    store = _ingested_store(spark, sf_dir)
    schema = "_raw_data string, tipo_mensagem string"
    return spark.read.schema(schema).json(store).select(
        "tipo_mensagem", F.get_json_object("_raw_data", "$.timestamp_evento").alias("timestamp_evento")
    )


@query
def event_stream_student(spark, sf_dir):
    """Student events streamed into the store, decoded from their envelopes and cleaned."""
    spec = tables.DADOS_ALUNO
    store = _ingested_store(spark, sf_dir)
    return clean(read_events(spark, store, "dados_aluno", spec.schema), spec)


def _delivered(spark: SparkSession, payloads: DataFrame, folder: str, store: str, checkpoint: str) -> None:
    """Deliver payloads as new files of ``folder`` and let the stream of this checkpoint take them in."""
    payloads.write.mode("append").parquet(folder)
    stream = spark.readStream.schema("body binary").parquet(folder)
    start_ingest(stream, store, checkpoint, trigger={"availableNow": True}).awaitTermination()


def _two_deliveries(spark: SparkSession, sf_dir: str, between: Callable[[str], object]) -> str:
    """A store that got the given events in two deliveries, those of the second half of the values twice; ``between`` comes in between."""
    events = standin.table(spark, sf_dir, "events")
    source, store, checkpoint = (work_folder(spark, label) for label in ("delivered", "store", "checkpoint"))
    _delivered(spark, standin.event_payloads(events.where("value >= 50")), source, store, checkpoint)
    between(store)
    _delivered(spark, standin.event_payloads(events), source, store, checkpoint)
    return store


@query
def event_store_merged(spark, sf_dir):
    """Lines of a store whose first files were merged and removed before the stream went on: how often each event type and time is there."""
    def merge(store):
        merge_events(spark, store, before="9999-01-01")
        remove_merged_files(spark, store)

    store = _two_deliveries(spark, sf_dir, merge)
    lines = event_lines(spark, store)
    payload = F.get_json_object("line", "$._raw_data")
    return lines.groupBy("tipo_mensagem", F.get_json_object(payload, "$.timestamp_evento").alias("timestamp_evento")).agg(F.count(F.lit(1)).alias("lines"))


@query
def silver_event_incremental(spark, sf_dir):
    """Student events cleaned in two updates, the second over new files only, which hold events of the first again."""
    spec, kind = tables.DADOS_ALUNO, "dados_aluno"
    silver = work_folder(spark, "silver")
    store = _two_deliveries(spark, sf_dir, lambda store: incremental.update_events(spark, store, silver, spec, kind))
    incremental.update_events(spark, store, silver, spec, kind)
    return incremental.silver_events(spark, silver)


# --- reports --------------------------------------------------------------------------------------


def _gaps(fact: DataFrame, realised: str) -> DataFrame:
    return report.with_gap(fact, realised, tables.TARGET_PREFIX, tables.TARGET_YEARS, "ano")


def _state_gaps(spark, sf_dir):
    """State gaps of the network that has targets."""
    fact = fact_state_target(spark, sf_dir).where(F.col("rede") == tables.STATE_NETWORKS[5])
    return _gaps(fact, "taxa_realizada")


@query
def report_gap(spark, sf_dir):
    return _gaps(fact_entity_target(spark, sf_dir), "taxa_realizada").select(
        "id_municipio", "ano", "rede", "taxa_realizada", "target", "gap"
    )


@query
def report_target_hit(spark, sf_dir):
    return report.target_hit(_gaps(fact_state_target(spark, sf_dir), "taxa_realizada")).select(
        "sigla_uf", "ano", "rede", "target", "gap", "hit"
    )


@query
def report_state_vs_target(spark, sf_dir):
    return report.realised_vs_target(_state_gaps(spark, sf_dir), "sigla_uf", "ano", "taxa_realizada")


@query
def report_kpis(spark, sf_dir):
    return report.national_kpis(
        _gaps(fact_national(spark, sf_dir), "taxa_alfabetizacao"),
        fact_student_aggregate(spark, sf_dir),
        "ano",
        "taxa_alfabetizacao",
        "total_alunos_avaliados",
    )


@query
def report_by_region(spark, sf_dir):
    nation, region = (standin.table(spark, sf_dir, name) for name in ("nation", "region"))
    regions = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_name").alias("sigla_uf"), F.col("r_name").alias("region")
    )
    return report.by_region(_state_gaps(spark, sf_dir), regions, "sigla_uf", "ano", "taxa_realizada")


@query
def report_top_bottom(spark, sf_dir):
    """The five largest and smallest state gaps of every year."""
    return report.top_bottom(_state_gaps(spark, sf_dir), "sigla_uf", "ano", 5)
