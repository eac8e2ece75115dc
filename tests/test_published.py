"""Tables published by manifest, and types of text columns found while writing."""

import json

import pytest
from conftest import plan_of, rows
from hypothesis import given, settings as limits, strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.sources import Conflict, land_csv, lattice, publish, read_csv_text, read_parquet, read_table, retire, snapshot
from stratalake.sources import published
from stratalake.sources.files import Files

SCHEMA = "id int, v string, ano int"


def frame(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


# --- publishing -----------------------------------------------------------------------------------


def half_way(spark):
    """Rows of which the last fails, after other tasks have written theirs."""
    bad = F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id"))
    return spark.range(0, 100, 1, 10).select(bad.cast("int").alias("id"), F.lit("new").alias("v"), F.lit(2024).alias("ano"))


@pytest.mark.parametrize("by", [(), ("ano",)])
def test_a_write_that_ends_half_way_changes_nothing(spark, tmp_path, by):
    root = str(tmp_path / "t")
    publish(frame(spark, (1, "a", 2024), (2, "b", 2025)), root, *by)
    for how in ("table", "partitions", "append"):
        with pytest.raises(Exception, match="lost"):
            publish(half_way(spark), root, *by, how=how, rebalance=False)
        assert rows(read_table(spark, root), "id", "v", "ano") == [(1, "a", 2024), (2, "b", 2025)]
    left = [d for d in (tmp_path / "t" / "_data").iterdir()]
    assert len(left) > 1 and retire(spark, root, min_age_s=0) == len(left) - 1
    assert read_table(spark, root).count() == 2


def test_readers_keep_their_state_while_others_publish(spark, tmp_path):
    root = str(tmp_path / "t")
    publish(frame(spark, (1, "a", 2024)), root)
    before = read_table(spark, root)
    publish(frame(spark, (2, "b", 2025)), root)
    assert rows(before, "id") == [(1,)] and rows(read_table(spark, root), "id") == [(2,)]
    assert rows(read_table(spark, root, number=1), "id") == [(1,)]
    # A plain read does not add up the versions.
    with pytest.raises(Exception, match="UNABLE_TO_INFER_SCHEMA"):
        spark.read.parquet(root)


def test_partitions_are_replaced_added_and_pruned(spark, tmp_path):
    root = str(tmp_path / "t")
    publish(frame(spark, (1, "a", 2023), (2, "b", 2024), (3, "c", None)), root, "ano")
    publish(frame(spark, (9, "z", 2024)), root, "ano", how="partitions")
    publish(frame(spark, (10, "y", 2023)), root, "ano", how="append")
    df = read_table(spark, root)
    assert rows(df, "id", "ano") == [(1, 2023), (10, 2023), (3, None), (9, 2024)]
    assert df.columns == ["id", "v", "ano"]
    pruned = df.where("ano = 2024")
    assert "PartitionFilters: [isnotnull(ano" in plan_of(pruned) and rows(pruned, "id") == [(9,)]
    with pytest.raises(ValueError, match="partitioned by"):
        publish(frame(spark, (1, "a", 1)), root, how="append")


def test_a_state_published_meanwhile_is_a_conflict_or_is_added_to(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    publish(frame(spark, (1, "a", 2024)), root)
    stale, now = snapshot(spark, root), published.snapshot
    publish(frame(spark, (2, "b", 2024)), root, how="append")
    monkeypatch.setattr(published, "snapshot", lambda *a: stale)
    with pytest.raises(Conflict):
        publish(frame(spark, (3, "c", 2024)), root)
    found = iter([stale])
    monkeypatch.setattr(published, "snapshot", lambda *a: next(found, None) or now(*a))
    publish(frame(spark, (4, "d", 2024)), root, how="append")
    monkeypatch.undo()
    assert rows(read_table(spark, root), "id") == [(1,), (2,), (4,)]


def test_files_are_created_whole_and_only_once(spark, tmp_path):
    files, path = Files(spark), str(tmp_path / "d" / "x.json")
    (tmp_path / "d").mkdir()
    files.create(path, "é" * 100_000)
    with pytest.raises(FileExistsError):
        files.create(path, "other")
    assert files.read(path) == "é" * 100_000 and [n for n in files.names(str(tmp_path / "d")) if not n.endswith(".crc")] == ["x.json"]
    assert files.names(str(tmp_path / "none")) == {}


def test_retiring_keeps_what_states_name(spark, tmp_path):
    root = str(tmp_path / "t")
    for i in range(4):
        publish(frame(spark, (i, "a", 2020 + i)), root, "ano", how="partitions")
    assert retire(spark, root, keep=1) == 0
    publish(frame(spark, (7, "b", 2020)), root, "ano", how="partitions")
    assert retire(spark, root, keep=1, min_age_s=0) == 1
    assert rows(read_table(spark, root), "id") == [(1,), (2,), (3,), (7,)]
    with pytest.raises(ValueError):
        retire(spark, root, keep=0)


@pytest.mark.parametrize("by", [(), ("ano",)])
def test_tables_without_rows(spark, tmp_path, by):
    root = str(tmp_path / "t")
    assert publish(frame(spark), root, *by, infer=True).rows == 0
    assert read_table(spark, root).count() == 0 and publish(frame(spark, (1, "a", 2)), root, *by, how="append").rows == 1
    assert rows(read_table(spark, root), "id") == [(1,)]
    with pytest.raises(FileNotFoundError):
        read_table(spark, str(tmp_path / "none"))


def test_counts_come_from_the_write_job(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = frame(spark, (1, "a", 1), (2, None, 1)).mapInArrow(count, SCHEMA)
    made = publish(df, str(tmp_path / "t"), infer=True, counting={"missing": F.count_if(F.col("v").isNull())})
    assert (made.rows, made.counts, seen.value) == (2, {"missing": 1}, 2)


# --- types ----------------------------------------------------------------------------------------

TYPED = [
    (["1", "-2", " ", None], "int"), (["1", "9999999999"], "bigint"), (["1", "2.5", "1e3", "NaN"], "double"),
    (["99999999999999999999"], "string"), (["true", "FALSE"], "boolean"), (["true", "1"], "string"), (["2024-02-29"], "date"),
    (["2024-02-30"], "string"), (["2024-02-29", "2024-02-29T10:00:00Z"], "timestamp"), (["n/d", "1"], "string"), ([None, ""], "string"),
    ([" 1"], "string"), (["."], "string"), (["007"], "int"),
]


@pytest.mark.parametrize("values, wanted", TYPED)
def test_types_of_text(spark, tmp_path, values, wanted):
    root = str(tmp_path / "t")
    made = publish(spark.createDataFrame([(v,) for v in values], "v string"), root, infer=True)
    df = read_table(spark, root)
    assert made.schema["v"].dataType.simpleString() == wanted == dict(df.dtypes)["v"]
    kept = [v for v in values if v is not None and v.strip()]
    assert df.where("v is not null" if wanted != "string" else "trim(v) <> ''").count() == len(kept)


FIELDS = [T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.DateType(), T.TimestampType(), T.StringType()]
ANY_FIELD = st.tuples(st.sampled_from(FIELDS), st.booleans()).map(lambda x: T.StructField("v", T.StringType() if x[1] else x[0], metadata=lattice.UNKNOWN if x[1] else None))


@given(ANY_FIELD, ANY_FIELD, ANY_FIELD)
@limits(max_examples=200, deadline=None)
def test_join_of_types_is_a_lattice(a, b, c):
    """Any order and grouping of parts gives the same type, and a type joined with itself stays."""
    kind = lambda f: (f.dataType, bool(f.metadata.get("unknown")))
    assert kind(lattice.join(a, a)) == kind(a)
    assert kind(lattice.join(a, b)) == kind(lattice.join(b, a))
    assert kind(lattice.join(lattice.join(a, b), c)) == kind(lattice.join(a, lattice.join(b, c))) == kind(lattice.join(a, b, c))


def test_wider_values_widen_a_column_without_losing_text(spark, tmp_path):
    root = str(tmp_path / "t")
    for day, (v, w) in enumerate([("007", None), ("8", "1"), ("2.50", ""), ("x", "2")]):
        df = spark.createDataFrame([(v, w, day)], "v string, w string, day int")
        publish(df, root, "day", how="append", infer=True)
        assert dict(read_table(spark, root).dtypes)["v"] == ["int", "int", "double", "string"][day]
    assert rows(read_table(spark, root), "v", "w") == [("007", None), ("2.50", None), ("8", 1), ("x", 2)]


def test_types_are_at_least_those_asked_for(spark, tmp_path):
    df = spark.createDataFrame([("1", "2", None)], "a string, b string, c string")
    made = publish(df, str(tmp_path / "t"), infer=True, at_least={"a": T.LongType(), "c": T.DoubleType()})
    assert [f.dataType.simpleString() for f in made.schema] == ["bigint", "int", "double"]


def test_csv_text_is_scanned_once(spark, tmp_path):
    """Opening reads a header; writing, counting and typing are one job that reads every line once."""
    path = tmp_path / "big.csv"
    path.write_text("a,b\n" + "".join(f"{i},x{i}\n" for i in range(100_000)))
    df = read_csv_text(spark, str(path))
    assert plan_of(df).count("FileScan csv") == 1
    spark.sparkContext.setJobGroup("land", "land")
    made = publish(df, str(tmp_path / "t"), infer=True)
    spark.sparkContext.setJobGroup("", "")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("land")) == 1
    assert made.rows == 100_000 and made.schema.simpleString() == "struct<a:int,b:string>"
    stored = json.loads(next((tmp_path / "t" / "_published").glob("0*.json")).read_text())
    assert len(stored["texts"]) == 2


def test_landing_days_with_other_types_and_columns(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id,v\n1,2\n")
    (tmp_path / "in" / "b.csv").write_text("v,id\n2.5,3\n")
    (tmp_path / "in" / "c.csv").write_text("﻿id,w\n4,x\n")
    (tmp_path / "in" / "d.csv").write_text("")
    out = str(tmp_path / "out")
    with pytest.raises(Exception, match="header"):
        land_csv(spark, str(tmp_path / "in"), out)
    assert land_csv(spark, str(tmp_path / "in"), out, variants=True).rows == 3
    got = read_parquet(spark, out)
    assert dict(got.dtypes)["v"] == "double"
    assert rows(got, "id", "v", "w") == [(1, 2.0, None), (3, 2.5, None), (4, None, "x")]


def test_landing_counts_unreadable_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,x\nzz,y\n")
    schema = spark.createDataFrame([], "a int, b string").schema
    made = land_csv(spark, str(tmp_path / "a.csv"), str(tmp_path / "out"), schema=schema)
    assert made.rows == 2 and made.counts == {"_unreadable": 1}
    assert rows(read_parquet(spark, str(tmp_path / "out")), "a", "_unreadable") == [(None, "zz,y"), (1, None)]


def test_a_partitioned_table_without_rows_keeps_its_columns(spark, tmp_path):
    root = str(tmp_path / "t")
    publish(frame(spark), root, "ano")
    assert read_table(spark, root).dtypes == [("id", "int"), ("v", "string"), ("ano", "int")]
    publish(frame(spark, (1, "a", 2023), (2, "b", 2024)), root, "ano")
    publish(frame(spark, (3, "c", 2025)), root, "ano", how="partitions", without=["ano=2023", "ano=2022"], after=2)
    assert rows(read_table(spark, root), "id") == [(2,), (3,)]
    with pytest.raises(Conflict):
        publish(frame(spark), root, "ano", how="partitions", after=2)
