"""The whole pipeline over files: landing, bronze, silver, gold, events and monitoring."""

import os
import sys

import duckdb
import pytest
from conftest import SMALL, rows

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check
from stratalake.plans import literacy, monitoring, oracle, standin
from stratalake.plans import literacy_tables as tables
from stratalake.sources import read_parquet
from stratalake.streaming import start_ingest


@pytest.fixture(scope="module")
def pipeline(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    landing = root / "landing"
    for spec in tables.LANDED_BATCH:
        raw = standin.raw(spark, SMALL, spec.name)
        raw.write.options(header=True, sep=spec.separator, ignoreLeadingWhiteSpace=False,
                          ignoreTrailingWhiteSpace=False).csv(str(landing / spec.file_name))
    layers = literacy.Layers(*(str(root / name) for name in ("bronze", "silver", "gold")))
    written = {
        "bronze": literacy.run_bronze(spark, str(landing), layers),
        "silver": literacy.run_silver(spark, layers),
        "gold": literacy.run_gold(spark, layers),
    }
    return layers, written


def sql_rows(name):
    connection = duckdb.connect()
    for table in check.TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    relation = connection.execute(oracle.oracle_queries()[name])
    return check.rows_of([d[0] for d in relation.description], relation.fetchall())


@pytest.mark.parametrize("layer, table, query", [
    ("silver", "uf", "silver_clean_state"),
    ("silver", "municipio", "silver_clean_entity"),
    ("silver", "meta_brasil", "silver_target_national"),
    ("silver", "meta_por_uf", None),
    ("silver", "meta_por_municipio", "silver_target_entity"),
    ("silver", "ts_municipio", "silver_clean_renamed"),
    ("silver", "ts_estado", "silver_clean_renamed_state"),
    ("silver", "ts_aluno", "silver_student"),
    ("gold", "dim_uf", "dim_state"),
    ("gold", "dim_municipio", "dim_entity"),
    ("gold", "dim_tempo", "dim_time"),
    ("gold", "fato_indicador", "fact_entity_target"),
    ("gold", "fato_indicador_uf", "fact_state_target"),
    ("gold", "fato_indicador_brasil", "fact_national"),
    ("gold", "fato_aluno_agregado", "fact_student_aggregate"),
])
def test_stored_tables_equal_sql(spark, pipeline, layer, table, query):
    layers, written = pipeline
    df = read_parquet(spark, f"{getattr(layers, layer)}/{table}")
    assert df.count() == written[layer][table] > 0
    if query:
        assert check.rows_of(df.columns, [tuple(r) for r in df.collect()]) == sql_rows(query)


def test_every_landed_table_is_in_bronze(spark, pipeline):
    layers, written = pipeline
    assert set(written["bronze"]) == {s.name for s in tables.LANDED_BATCH}
    for spec in tables.LANDED_BATCH:
        assert written["bronze"][spec.name] == standin.raw(spark, SMALL, spec.name).count()


def test_running_again_gives_the_same_gold(spark, pipeline):
    layers, written = pipeline
    assert literacy.run_gold(spark, layers) == written["gold"]


def test_monitoring_of_the_silver_layer(spark, pipeline):
    layers, written = pipeline
    report = monitoring.monitor(spark, monitoring.literacy_watches(spark, layers.silver))
    volumes = dict(rows(report.where("check = 'volume'"), "dataset", "value"))
    assert volumes == written["silver"]
    critical = rows(report.where("dataset = 'ts_aluno' and check = 'nulls'"), "subject")
    assert critical == sorted((c,) for c in tables.STUDENT_CRITICAL_COLUMNS)
    assert report.where("dataset = 'municipio' and subject = 'duplicate_groups' and severity = 'alert'").count() == 1
    relations = {r["relation"]: r["has_orphans"] for r in monitoring.literacy_relations(spark, layers.silver).collect()}
    assert relations == {"uf x meta_por_uf": True, "municipio x meta_por_municipio": True, "ts_aluno x municipio": True}


def test_gold_facts_point_into_their_dimensions(spark, pipeline):
    layers, _ = pipeline
    found = {r["relation"]: r["orphan_keys"] for r in monitoring.star_relations(spark, layers.gold).collect()}
    # Students come from municipalities that have no realised row, so the dimension lacks some of them.
    assert found.pop("fato_aluno_agregado x dim_municipio") > 0
    assert found == {"fato_indicador x dim_municipio": 0, "fato_indicador x dim_tempo": 0,
                     "fato_indicador_uf x dim_uf": 0}


def test_events_from_stream_to_silver(spark, pipeline, tmp_path):
    layers = literacy.Layers(*(str(tmp_path / name) for name in ("bronze", "silver", "gold")))
    source = f"{SMALL}/{{events.parquet}}"
    schema = spark.read.parquet(f"{SMALL}/events.parquet").schema
    stream = standin.event_payloads(spark.readStream.schema(schema).parquet(source))
    store = str(tmp_path / "store")
    start_ingest(stream, store, str(tmp_path / "checkpoint"), trigger={"availableNow": True}).awaitTermination()
    bronze = literacy.run_bronze_events(spark, store, layers)
    silver = literacy.run_silver(spark, layers, tables.EVENTS.values())
    names = {s.name for s in tables.EVENTS.values()}
    assert set(silver) == names and names <= set(bronze)
    given = {r[0]: r[1] for r in spark.read.parquet(f"{SMALL}/events.parquet").groupBy("event_type").count().collect()}
    # Only the events without a type are left out, and no stored event is damaged.
    assert {k: bronze[k] for k in set(bronze) - names} == {"unknown": given["error"]}
    queries = {"stream_aluno": "silver_event_student", "stream_municipio": "silver_event_entity",
               "stream_indicadores": "silver_event_indicator", "stream_itens": "silver_event_item"}
    for table, query in queries.items():
        df = read_parquet(spark, f"{layers.silver}/{table}")
        assert check.rows_of(df.columns, [tuple(r) for r in df.collect()]) == sql_rows(query)
