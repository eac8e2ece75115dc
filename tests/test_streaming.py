import json

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from stratalake.operators.clean import clean
from stratalake.plans import literacy_tables as tables
from stratalake.sources import decode_events, read_events, read_parquet
from stratalake.streaming import envelope, start_ingest

STUDENT = {
    "tipo_mensagem": "dados_aluno", "NU_ANO": 2023, "CO_UF": 53, "SG_UF": " df", "ID_ALUNO": 777, "TP_SERIE": 2,
    "ID_ESCOLA": 42, "TP_DEPENDENCIA": 3, "CO_MUNICIPIO": 5300108, "NO_MUNICIPIO": "Vila Nova", "IN_PRESENCA": 1,
    "VL_PROFICIENCIA": 512.5, "IN_ALFABETIZADO": 1, "timestamp_evento": "2026-07-01T10:00:00.000001",
}
BODIES = [json.dumps(STUDENT), json.dumps({"ID_ALUNO": 1}), "<no json>", None, json.dumps({"tipo_mensagem": ""})]


def bodies(spark, values=BODIES):
    return spark.createDataFrame([(v.encode() if v is not None else None,) for v in values], "body binary")


def test_events_go_to_their_type_or_to_unknown(spark):
    got = rows(envelope(bodies(spark)), "_raw_data", "tipo_mensagem")
    assert got == sorted([(b, "dados_aluno" if b == BODIES[0] else "unknown") for b in BODIES],
                         key=lambda t: [(v is not None, str(v)) for v in t])


def test_envelope_keeps_the_ingestion_time(spark):
    row = envelope(bodies(spark)).first()
    assert row["_bronze_timestamp"] is not None
    assert row["ingest_year"] == f"{row['_bronze_timestamp']:%Y}"


def test_decoding_types_every_field(spark):
    schema = tables.DADOS_ALUNO.schema
    got = decode_events(envelope(bodies(spark)), schema)
    assert got.schema == schema
    by_id = {r["ID_ALUNO"]: r for r in got.collect()}
    assert by_id[777].asDict() == STUDENT and by_id[1]["tipo_mensagem"] is None
    assert got.where("ID_ALUNO IS NULL").count() == 3


@pytest.mark.parametrize("kind, spec", tables.EVENTS.items())
def test_every_event_type_survives_store_and_cleaning(spark, tmp_path, kind, spec):
    value = {"int": 7, "bigint": 8, "double": 1.5, "string": " ro"}
    event = {f.name: value[f.dataType.simpleString()] for f in spec.schema.fields} | {"tipo_mensagem": kind}
    store = tmp_path / f"tipo_mensagem={kind}" / "ingest_year=2026" / "ingest_month=07" / "ingest_day=01"
    store.mkdir(parents=True)
    # The same event flat, in an envelope, and delivered again another day.
    lines = [json.dumps(event), json.dumps({"_raw_data": json.dumps(event), "_bronze_timestamp": "2026-07-01"})]
    (store / "a.json").write_text("\n".join(lines) + "\n")
    again = tmp_path / f"tipo_mensagem={kind}" / "ingest_year=2026" / "ingest_month=07" / "ingest_day=02"
    again.mkdir()
    (again / "b.json").write_text(lines[0] + "\n")
    typed = read_events(spark, str(tmp_path), kind, spec.schema)
    assert typed.schema == spec.schema and typed.count() == 3
    cleaned = clean(typed, spec)
    assert cleaned.count() == 1
    row = cleaned.first().asDict()
    assert row["ano"] == 7 and row["sigla_uf"] == "RO" and "NU_ANO" not in row


def test_events_without_their_key_are_dropped(spark):
    spec = tables.DADOS_ALUNO
    event = {**STUDENT, "CO_MUNICIPIO": None}
    assert clean(decode_events(envelope(bodies(spark, [json.dumps(event)])), spec.schema), spec).count() == 0


def run(spark, landing, store, checkpoint):
    stream = spark.readStream.schema("body string").text(str(landing)).withColumn("body", F.col("body").cast("binary"))
    query = start_ingest(stream, str(store), str(checkpoint), trigger={"availableNow": True})
    query.awaitTermination()


def test_stream_restart_reads_only_what_is_new(spark, tmp_path):
    landing, store, checkpoint = tmp_path / "landing", tmp_path / "store", tmp_path / "checkpoint"
    landing.mkdir()
    (landing / "1.txt").write_text("\n".join(b for b in BODIES[:3]) + "\n")
    run(spark, landing, store, checkpoint)
    run(spark, landing, store, checkpoint)
    assert rows(spark.read.json(str(store)).groupBy("tipo_mensagem").count()) == [("dados_aluno", 1), ("unknown", 2)]
    (landing / "2.txt").write_text(json.dumps({**STUDENT, "ID_ALUNO": 2}) + "\n")
    run(spark, landing, store, checkpoint)
    students = read_events(spark, str(store), "dados_aluno", tables.DADOS_ALUNO.schema)
    assert rows(students, "ID_ALUNO", "VL_PROFICIENCIA") == [(2, 512.5), (777, 512.5)]
    stored = spark.read.json(str(store))
    assert {"_raw_data", "_bronze_timestamp", "ingest_year", "ingest_month", "ingest_day"} <= set(stored.columns)
    assert stored.where("_bronze_timestamp IS NULL").count() == 0


def test_files_of_a_failed_attempt_are_not_read(spark, tmp_path):
    landing, store = tmp_path / "landing", tmp_path / "store"
    landing.mkdir()
    (landing / "1.txt").write_text(BODIES[0] + "\n")
    run(spark, landing, store, tmp_path / "checkpoint")
    committed = next((store / "tipo_mensagem=dados_aluno").rglob("*.json"))
    (committed.parent / "part-00000-left-over.json").write_text(committed.read_text())
    assert read_events(spark, str(store), "dados_aluno", tables.DADOS_ALUNO.schema).count() == 1


def test_reading_one_type_prunes_the_others(spark, tmp_path):
    landing, store = tmp_path / "landing", tmp_path / "store"
    landing.mkdir()
    (landing / "1.txt").write_text("\n".join(BODIES[:3]) + "\n")
    run(spark, landing, store, tmp_path / "checkpoint")
    events = read_events(spark, str(store), "dados_aluno", tables.DADOS_ALUNO.schema)
    assert "(tipo_mensagem" in plan_of(events).split("PartitionFilters")[1].split("PushedFilters")[0]


def test_types_that_are_not_known_do_not_become_folders(spark, tmp_path):
    landing, store = tmp_path / "landing", tmp_path / "store"
    landing.mkdir()
    strange = [json.dumps({**STUDENT, "tipo_mensagem": kind}) for kind in ("x" * 300, "../up", "other")]
    (landing / "1.txt").write_text("\n".join([*strange, BODIES[0]]) + "\n")
    run(spark, landing, store, tmp_path / "checkpoint")
    stored = spark.read.json(str(store))
    assert rows(stored.groupBy("tipo_mensagem").count()) == [("dados_aluno", 1), ("unknown", 3)]
    assert {r[0] for r in rows(stored.where("tipo_mensagem = 'unknown'"), "_raw_data")} == set(strange)
    own = envelope(bodies(spark, strange), known_types=["other"])
    assert own.where("tipo_mensagem = 'other'").count() == 1


def test_files_delivered_by_hand_are_refused_or_included(spark, tmp_path):
    from stratalake.plans import literacy
    from stratalake.sources import files_outside_log

    landing, store = tmp_path / "landing", tmp_path / "store"
    landing.mkdir()
    (landing / "1.txt").write_text(BODIES[0] + "\n")
    run(spark, landing, store, tmp_path / "checkpoint")
    assert files_outside_log(spark, str(store)) == []
    committed = next((store / "tipo_mensagem=dados_aluno").rglob("*.json"))
    (committed.parent / "by-hand.json").write_text(json.dumps({**STUDENT, "ID_ALUNO": 2}) + "\n")
    layers = literacy.Layers(*[str(tmp_path / name) for name in ("bronze", "silver", "gold")])
    with pytest.raises(ValueError, match="by-hand.json"):
        literacy.run_bronze_events(spark, str(store), layers)
    assert literacy.run_bronze_events(spark, str(store), layers, "ignore")["stream_aluno"] == 1
    assert literacy.run_bronze_events(spark, str(store), layers, "include")["stream_aluno"] == 2
    assert rows(read_parquet(spark, f"{layers.bronze}/stream_aluno"), "ID_ALUNO") == [(2,), (777,)]
