from conftest import SMALL, rows
from pyspark.sql import functions as F

from stratalake.operators import quality
from stratalake.plans import monitoring, standin


def test_null_profile_of_an_empty_table_is_zero(spark):
    empty = spark.createDataFrame([], "a int, `b.c` string")
    assert rows(quality.null_profile(empty)) == [("a", 0), ("b.c", 0)]


def test_null_profile_counts(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert rows(quality.null_profile(df)) == [("a", 1), ("b", 2)]
    assert rows(quality.null_profile(df, ["b"])) == [("b", 2)]


def test_duplicate_groups_and_surplus_rows(spark):
    df = spark.createDataFrame([(1, "a")] * 3 + [(2, "b"), (None, "c"), (None, "d")], "k int, v string")
    assert rows(quality.duplicate_keys(df, ["k"])) == [(2, 3, True)]
    assert rows(quality.duplicate_keys(df, df.columns)) == [(1, 2, True)]
    assert rows(quality.duplicate_keys(df.limit(0), ["k"])) == [(0, 0, False)]


def test_full_row_duplicates_equal_count_minus_distinct_count(spark):
    raw = standin.raw(spark, SMALL, "municipio")
    surplus = quality.duplicate_keys(raw, raw.columns).first()["surplus_rows"]
    assert surplus == raw.count() - raw.distinct().count() > 0


def test_orphans_with_a_null_part_never_match(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "a")], "k int, s string")
    right = spark.createDataFrame([(1, "a"), (None, "a")], "k int, s string")
    assert rows(quality.orphans(left, right, ["k", "s"])) == [(None, "a", 1), (2, "b", 1)]
    assert rows(quality.orphan_summary(left, right, ["k", "s"])) == [(2, 2, True)]
    assert rows(quality.orphan_summary(right.where("k = 1"), right, ["k", "s"])) == [(0, 0, False)]


def test_orphans_with_differently_named_keys(spark):
    left = spark.createDataFrame([(1,), (5,), (5,)], "CO_MUNICIPIO long")
    right = spark.createDataFrame([(1,), (2,)], "id_municipio long")
    got = quality.orphans(left, right, [("CO_MUNICIPIO", "id_municipio")])
    assert got.columns == ["CO_MUNICIPIO", "row_count"] and rows(got) == [(5, 2)]


def test_volume_names_empty_tables(spark):
    df = spark.range(3)
    assert rows(quality.volume(df)) == [(3, "ok")]
    assert rows(quality.volume(df.limit(0))) == [(0, "empty")]


def test_fact_profile(spark):
    df = spark.createDataFrame([(1, 2024, 5.0), (None, 2024, None), (2, 2025, 9.0), (3, None, 1.0)],
                               "id int, ano int, taxa double")
    profile = quality.fact_profile(df, "id", "taxa", "ano").first().asDict()
    assert profile == {"row_count": 4, "null_keys": 1, "null_measures": 1, "min_measure": 1.0, "max_measure": 9.0,
                       "periods": 2, "first_period": 2024, "last_period": 2025, "period_list": "2024,2025"}
    empty = quality.fact_profile(df.limit(0), "id", "taxa", "ano").first()
    assert (empty["row_count"], empty["null_keys"], empty["min_measure"], empty["periods"]) == (0, 0, None, 0)


def watches(spark, tmp_path):
    good, dirty, empty = (str(tmp_path / n) for n in ("good", "dirty", "empty"))
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").write.parquet(good)
    spark.createDataFrame([(1, None), (1, "b")], "k int, v string").write.parquet(dirty)
    spark.createDataFrame([], "k int, v string").write.parquet(empty)
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"not parquet")
    paths = {"good": good, "dirty": dirty, "empty": empty, "absent": str(tmp_path / "absent")}
    found = {n: monitoring.Watch(lambda p=p: spark.read.parquet(p), ["k"]) for n, p in paths.items()}
    # Declared schema: the damage shows only when the job reads the file, not when the table is opened.
    found["broken"] = monitoring.Watch(lambda: spark.read.schema("k int, v string").parquet(str(broken)), ["k"])
    return found


def test_monitor_reports_findings_and_goes_on_after_failures(spark, tmp_path):
    report = monitoring.monitor(spark, watches(spark, tmp_path))
    alerts = rows(report.where("severity = 'alert'"), "dataset", "check", "subject", "value")
    assert alerts == [
        ("absent", "read_failed", None, None),
        ("broken", "read_failed", None, None),
        ("dirty", "duplicates", "duplicate_groups", 1),
        ("dirty", "duplicates", "surplus_rows", 1),
        ("dirty", "nulls", "v", 1),
        ("empty", "volume", "rows", 0),
    ]
    assert report.where("dataset = 'good' and severity = 'ok'").count() == 5
    assert report.where(F.col("elapsed_s").isNull() | (F.col("elapsed_s") < 0)).count() == 0
    assert report.where("dataset = 'total' and check = 'latency'").count() == 1
    assert report.where("check = 'read_failed' and message is null").count() == 0


def test_monitor_fail_fast_raises(spark, tmp_path):
    import pytest

    found = watches(spark, tmp_path)
    with pytest.raises(Exception):
        monitoring.monitor(spark, {"broken": found["broken"]}, fail_fast=True)


def test_null_profile_can_come_from_parquet_footers(spark, tmp_path, settings):
    from conftest import plan_of

    path = str(tmp_path / "t")
    spark.createDataFrame([(1, None), (None, "b")], "k int, v string").write.parquet(path)
    settings(spark__sql__sources__useV1SourceList="", spark__sql__parquet__aggregatePushdown="true")
    profile = quality.null_profile(spark.read.parquet(path))
    assert rows(profile) == [("k", 1), ("v", 1)]
    assert "PushedAggregation: [COUNT(*), COUNT(k), COUNT(v)]" in plan_of(profile)


def test_cleaning_effect_explains_every_row(spark):
    from stratalake.operators.clean import clean
    from stratalake.plans import literacy_tables as tables

    raw = standin.raw(spark, SMALL, "municipio")
    effect = quality.cleaning_effect(raw, tables.MUNICIPIO).first().asDict()
    assert effect["rows_before"] == raw.count()
    assert effect["rows_after"] == clean(raw, tables.MUNICIPIO).count()
    assert effect["rows_before"] - effect["rows_without_key"] - effect["surplus_copies"] == effect["rows_after"]
    assert min(effect.values()) > 0
    assert rows(quality.cleaning_effect(raw.limit(0), tables.MUNICIPIO)) == [(0, 0, 0, 0)]


def test_monitor_reports_relations_copies_and_unreadable_references(spark, tmp_path):
    from stratalake.plans.monitoring import Relation, Watch, monitor

    facts = spark.createDataFrame([(1, "a"), (1, "a"), (3, "b"), (None, "c")], "k int, v string")
    known = spark.createDataFrame([(1,), (1,), (2,)], "id int")

    def fail():
        raise RuntimeError

    relations = {"known": Relation(lambda: known, [("k", "id")], unique=True), "lost": Relation(fail, ["k"])}
    report = monitor(spark, {"facts": Watch(lambda: facts, ["k"], relations=relations, whole_rows=True)})
    found = {(r["check"], r["subject"]): (r["value"], r["severity"]) for r in report.collect()}
    assert found["orphans", "known"] == (2, "alert")
    assert found["reference_repeats", "known"] == (1, "alert")
    assert found["row_copies", "surplus_rows"] == (1, "alert")
    assert found["read_failed", "lost"] == (None, "alert")
    assert report.where("check = 'read_failed'").first()["message"] == "RuntimeError"
    assert found["volume", "rows"] == (4, "ok") and found["nulls", "k"] == (1, "alert")


def test_findings_scan_a_table_twice(spark, tmp_path):
    from conftest import plan_of

    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "rows")], "k int, rows string").write.parquet(path)
    found = monitoring.findings(spark.read.parquet(path), monitoring.Watch(None, ["k"]))
    assert plan_of(found).count("FileScan") == 2
    assert ("volume", "rows", 1) in rows(found)
