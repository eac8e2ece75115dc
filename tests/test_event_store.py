"""Quarantine of events, merging of a store's files, and silver tables that grow with what is new."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.clean import clean
from stratalake.plans import incremental, literacy
from stratalake.plans import literacy_tables as tables
from stratalake.sources import decode_lines, event_lines, read_events, read_table
from stratalake.sources.events import BAD_PAYLOAD, MISFIT, NO_FIELD, NO_JSON, committed_files, merged_root
from stratalake.streaming import merge_events, remove_merged_files, start_ingest

SPEC, KIND = tables.DADOS_ALUNO, "dados_aluno"


def student(i, **changed):
    return json.dumps({"tipo_mensagem": KIND, "NU_ANO": 2024, "SG_UF": "ro", "ID_ALUNO": i, "CO_MUNICIPIO": 7, **changed})


class Store:
    def __init__(self, spark, folder):
        self.spark, self.folder, self.store, self.n = spark, folder, str(folder / "store"), 0
        (folder / "in").mkdir()

    def deliver(self, *bodies):
        self.n += 1
        (self.folder / "in" / f"{self.n}.txt").write_text("\n".join(bodies) + "\n")
        stream = self.spark.readStream.schema("body string").text(str(self.folder / "in"))
        start_ingest(stream, self.store, str(self.folder / "checkpoint"), trigger={"availableNow": True}).awaitTermination()

    def lines(self):
        return sorted(json.loads(r["line"])["_raw_data"] for r in event_lines(self.spark, self.store).collect())

    def files(self):
        return len(list((self.folder / "store").rglob("part-*.json")))


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, tmp_path)


# --- quarantine -----------------------------------------------------------------------------------

LINES = [
    ('{"a":1,"b":"x"}', (1, "x", None)), ('{"a":"z","b":"x"}', (None, "x", MISFIT)), ("nope", (None, None, NO_JSON)),
    ('{"a":1,"b"', (None, None, NO_JSON)), ('{"_raw_data":"{\\"a\\":5}"}', (5, None, None)), ('{"_raw_data":"nope"}', (None, None, BAD_PAYLOAD)),
    ('{"_raw_data":"{\\"a\\":\\"q\\",\\"b\\":\\"r\\"}"}', (None, "r", MISFIT)), ('{"c":1}', (None, None, NO_FIELD)), ("[1]", (None, None, NO_JSON)),
    ("5", (None, None, NO_JSON)), ('{"a":99999999999,"b":"k"}', (None, "k", MISFIT)), ('{"_raw_data":null,"t":1}', (None, None, NO_FIELD)),
    ('{"a":1,"_raw_data":"{\\"b\\":\\"e\\"}"}', (1, "e", None)), ('{"_raw_data":"[]"}', (None, None, BAD_PAYLOAD)),
]


@pytest.mark.parametrize("line, wanted", LINES)
def test_lines_are_decoded_or_refused(spark, line, wanted):
    df = spark.createDataFrame([(line,), ("  ",), ("",)], "line string")
    got = decode_lines(df, T.StructType.fromDDL("a int, b string")).collect()
    assert [tuple(r) for r in got] == [(*wanted, None if wanted[2] is None else line)]


def test_of_four_lines_one_is_an_event(spark, tmp_path):
    """Refused lines are kept with their reason, and neither table nor silver holds rows of NULLs."""
    folder = tmp_path / "store" / f"tipo_mensagem={KIND}"
    folder.mkdir(parents=True)
    lines = [student(1), "{torn", '{"_raw_data":"{torn"}', student(2, NU_ANO="n/d")]
    (folder / "a.json").write_text("\n".join(lines) + "\n")
    assert rows(read_events(spark, str(tmp_path / "store"), KIND, SPEC.schema), "ID_ALUNO", "NU_ANO") == [(1, 2024), (2, None)]
    layers = literacy.Layers(*(str(tmp_path / n) for n in ("bronze", "silver", "gold")))
    written = literacy.run_bronze_events(spark, str(tmp_path / "store"), layers)
    assert {k: v for k, v in written.items() if v} == {"stream_aluno": 2, "stream_aluno._refused": 2, "stream_aluno._changed": 1}
    kept = rows(literacy.quarantine(spark, layers), "table", "reason", "line")
    assert kept == sorted([("stream_aluno", NO_JSON, lines[1]), ("stream_aluno", BAD_PAYLOAD, lines[2]), ("stream_aluno", MISFIT, lines[3])], key=lambda t: [(v is not None, v) for v in t])
    assert literacy.run_silver(spark, layers, [SPEC]) == {"stream_aluno": 2}


# --- merging --------------------------------------------------------------------------------------


def test_merging_keeps_every_line_once(spark, store):
    for i in range(4):
        store.deliver(student(i), "no json", student(i))
    before = store.lines()
    assert len(before) == 12 and store.files() == 8
    assert merge_events(spark, store.store) == 0, "today is left alone"
    assert merge_events(spark, store.store, "9999-01-01") == 8
    assert store.lines() == before, "small files still there, read once"
    assert remove_merged_files(spark, store.store) == 8 and store.files() == 0
    assert len(list((store.folder / "store" / "_merged" / "_data").rglob("*.parquet"))) < 8
    assert store.lines() == before
    store.deliver(student(9))
    assert store.lines() == sorted([*before, student(9)]), "a restart adds only what is new"
    assert merge_events(spark, store.store, "9999-01-01") == 1 and merge_events(spark, store.store, "9999-01-01") == 0
    assert store.lines() == sorted([*before, student(9)])
    assert rows(read_events(spark, store.store, KIND, SPEC.schema).select("ID_ALUNO").distinct()) == [(0,), (1,), (2,), (3,), (9,)]


def test_a_merge_that_ends_half_way_changes_nothing(spark, store, monkeypatch):
    from stratalake.streaming import compaction

    store.deliver(student(1))
    store.deliver(student(2))
    before = store.lines()
    failing = lambda df: df.withColumn("line", F.raise_error(F.lit("lost")))
    monkeypatch.setattr(compaction, "lines_of", lambda *a: failing(event_lines(spark, store.store)))
    with pytest.raises(Exception, match="lost"):
        merge_events(spark, store.store, "9999-01-01")
    monkeypatch.undo()
    assert store.lines() == before
    assert merge_events(spark, store.store, "9999-01-01") == 2 and store.lines() == before


def test_files_delivered_by_hand_count_beside_merged_ones(spark, store):
    store.deliver(student(1))
    merge_events(spark, store.store, "9999-01-01")
    remove_merged_files(spark, store.store)
    store.deliver(student(2))
    committed = next((store.folder / "store" / f"tipo_mensagem={KIND}").rglob("*.json"))
    (committed.parent / "by-hand.json").write_text(student(3) + "\n")
    ids = lambda **k: rows(read_events(spark, store.store, KIND, SPEC.schema, **k), "ID_ALUNO")
    assert ids() == [(1,), (2,)] and ids(committed_only=False) == [(1,), (2,), (3,)]


def test_the_log_is_read_through_its_sums(spark, store, settings):
    settings(spark__sql__streaming__fileSink__log__compactInterval="2")
    for i in range(5):
        store.deliver(student(i))
    assert any(p.name.endswith(".compact") for p in (store.folder / "store" / "_spark_metadata").iterdir())
    found = committed_files(spark, store.store).collect()
    assert len(found) == len({r["path"] for r in found}) == 5 and {r["tipo_mensagem"] for r in found} == {KIND}


# --- incremental silver ---------------------------------------------------------------------------


def whole(spark, store):
    return rows(clean(read_events(spark, store.store, KIND, SPEC.schema), SPEC))


def test_updates_equal_the_whole_and_read_new_files_only(spark, store):
    silver = str(store.folder / "silver")
    update = lambda: incremental.update_events(spark, store.store, silver, SPEC, KIND)
    store.deliver(student(1), student(2), student(2), student(3, CO_MUNICIPIO=None), "no json")
    assert update() == incremental.Update(1, 2, 0)
    assert update() == incremental.Update(0, 0, 0)
    store.deliver(student(2), student(4), student(1, SG_UF=" RO"))
    # The first file may change or go: it is not read again.
    first = next(p for p in (store.folder / "store" / f"tipo_mensagem={KIND}").rglob("*.json") if '\\"ID_ALUNO\\":3' in p.read_text() or '"ID_ALUNO\\": 3' in p.read_text())
    held = first.read_text()
    first.write_text("")
    assert update() == incremental.Update(1, 2, 1)
    first.write_text(held)
    for crc in first.parent.glob(".*.crc"):
        crc.unlink()
    assert rows(incremental.silver_events(spark, silver)) == whole(spark, store)


def test_updates_read_files_that_were_merged_meanwhile(spark, store):
    silver = str(store.folder / "silver")
    store.deliver(student(1))
    incremental.update_events(spark, store.store, silver, SPEC, KIND)
    store.deliver(student(2), student(1))
    merge_events(spark, store.store, "9999-01-01")
    remove_merged_files(spark, store.store)
    store.deliver(student(3))
    assert incremental.update_events(spark, store.store, silver, SPEC, KIND) == incremental.Update(2, 2, 1)
    assert rows(incremental.silver_events(spark, silver)) == whole(spark, store)
    assert {r["_file"].split("/")[0] for r in read_table(spark, merged_root(store.store)).collect()} == {f"tipo_mensagem={KIND}"}


def test_an_update_that_ends_half_way_is_done_again(spark, store, monkeypatch):
    silver = str(store.folder / "silver")
    store.deliver(student(1))
    incremental.update_events(spark, store.store, silver, SPEC, KIND)
    store.deliver(student(2))
    project = incremental.project
    monkeypatch.setattr(incremental, "project", lambda df, spec: project(df, spec).withColumn("ano", F.raise_error(F.lit("lost")).cast("int")))
    with pytest.raises(Exception, match="lost"):
        incremental.update_events(spark, store.store, silver, SPEC, KIND)
    monkeypatch.undo()
    assert rows(incremental.silver_events(spark, silver), "ID_ALUNO") == [(1,)]
    assert incremental.update_events(spark, store.store, silver, SPEC, KIND) == incremental.Update(1, 1, 0)


def test_history_is_not_shuffled_for_few_new_rows(spark, store):
    """Of the stored rows only digests are read, and the few new ones are broadcast to them."""
    old, new = (str(store.folder / n) for n in ("old", "new"))
    spark.range(100_000).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("_digest"), F.lit("wide").alias("w")).write.parquet(old)
    spark.range(10).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("_digest")).write.parquet(new)
    again = spark.read.parquet(old).select("_digest").join(spark.read.parquet(new), "_digest", "left_semi")
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "w#" not in plan


def test_a_store_without_a_log_is_cleaned_whole(spark, tmp_path):
    with pytest.raises(ValueError, match="log"):
        incremental.update_events(spark, str(tmp_path), str(tmp_path / "s"), SPEC, KIND)


def test_all_types_are_updated(spark, store):
    store.deliver(student(1), json.dumps({"tipo_mensagem": "dados_municipio", "CO_MUNICIPIO": 5}))
    made = incremental.run_silver_events(spark, store.store, str(store.folder / "silver"))
    assert {k: u.added for k, u in made.items()} == {"stream_aluno": 1, "stream_municipio": 1, "stream_indicadores": 0, "stream_itens": 0}
