"""Profiles kept with published tables, and monitoring that reads them instead of the data."""

import pytest
from conftest import rows

from stratalake.plans import monitoring
from stratalake.sources import publish, read_table, retire, table_profile
from stratalake.sources import published

SCHEMA = "id long, v string, x double, d date, year int"


def frame(spark, *values):
    import datetime

    return spark.createDataFrame([(i, v, x, datetime.date(2024, 1, d) if d else None, y) for i, v, x, d, y in values], SCHEMA)


def expected(df):
    """The profile by plain Python."""
    data = df.collect()
    made = []
    for name, kind in df.dtypes:
        own = [r[name] for r in data if r[name] is not None]
        ends = (None, None) if not own or kind.startswith("array") else (str(min(own)), str(max(own)))
        made.append((name, len(data), len(data) - len(own), *ends))
    return sorted(made)


@pytest.fixture
def no_scan(monkeypatch):
    """Make every read of a table's data an error."""
    def refuse(*args, **kwargs):
        raise AssertionError("the data was read")

    return lambda: monkeypatch.setattr(published, "_scan", refuse)


@pytest.mark.parametrize("by", [(), ("year",)])
def test_profiles_of_several_writes_merge_without_reading_data(spark, tmp_path, no_scan, by):
    root = str(tmp_path / "t")
    publish(frame(spark, (1, "b", 2.5, 3, 2024), (None, "", None, None, 2024), (9, None, -1.0, 9, 2025)), root, *by, profile=True)
    publish(frame(spark, (10, "a b", 1e10, 1, 2025), (-3, "é", 0.5, None, 2026)), root, *by, how="partitions" if by else "append", profile=True)
    want = [(n, c, k, *(("1.0E10" if e == "10000000000.0" else e) for e in ends)) for n, c, k, *ends in expected(read_table(spark, root))]
    no_scan()
    assert rows(table_profile(spark, root)) == want
    assert rows(table_profile(spark, root, 1), "row_count") == [(3,)] * 5


def test_parts_without_a_profile_are_scanned_and_odd_partitions_found(spark, tmp_path):
    root = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a/b=c d%"), (2, None), (None, "é+x")], "_rows long, part string")
    publish(first, root, "part", profile=True)
    publish(spark.createDataFrame([(7, "z")], "_rows long, part string"), root, "part", how="append")
    assert rows(table_profile(spark, root)) == expected(read_table(spark, root))


def test_a_column_that_widens_keeps_numbers_and_measures_text_again(spark, tmp_path, no_scan, monkeypatch):
    root = str(tmp_path / "t")
    publish(spark.createDataFrame([("2", "2024-01-05"), ("10", None), (" ", "2024-01-02")], "a string, b string"), root, infer=True, profile=True)
    publish(spark.createDataFrame([("7.5", "2024-01-03T12:00:00Z")], "a string, b string"), root, how="append", infer=True, profile=True)
    assert rows(table_profile(spark, root).where("column_name = 'a'")) == [("a", 4, 1, "2.0", "10.0")]
    low, high = read_table(spark, root).selectExpr("string(min(b))", "string(max(b))").first()
    assert rows(table_profile(spark, root).where("column_name = 'b'")) == [("b", 4, 1, low, high)]
    publish(spark.createDataFrame([("x", "y", "new")], "a string, b string, c string"), root, how="append", infer=True, profile=True)
    assert rows(table_profile(spark, root)) == expected(read_table(spark, root))


def test_empty_and_unordered(spark, tmp_path):
    root = str(tmp_path / "t")
    publish(spark.createDataFrame([([1], True), (None, False)], "a array<int>, b boolean"), root, profile=True)
    assert rows(table_profile(spark, root)) == [("a", 2, 1, None, None), ("b", 2, 0, "false", "true")]
    for by in ((), ("b",)):
        publish(spark.createDataFrame([], "a array<int>, b boolean"), f"{root}{len(by)}", *by, profile=True)
        assert rows(table_profile(spark, f"{root}{len(by)}")) == [("a", 0, 0, None, None), ("b", 0, 0, None, None)]


def test_an_unchanged_table_is_monitored_without_a_scan(spark, tmp_path, no_scan):
    root = str(tmp_path / "t")
    df = frame(spark, (1, "b", 2.5, 3, 2024), (1, "c", None, None, 2024), (9, None, -1.0, 9, 2025), (9, None, -1.0, 9, 2025))
    publish(df, root, "year", profile=True)
    watch = monitoring.Watch(lambda: read_table(spark, root), ["id"], ["id", "v"], whole_rows=True, stored=root)
    plain = rows(monitoring.findings(df, watch))
    assert rows(monitoring.stored_findings(spark, watch)) == plain
    publish(df, root, "year", how="append", profile=True)
    again = rows(monitoring.stored_findings(spark, watch))
    assert again == rows(monitoring.findings(df.union(df), watch)) != plain
    no_scan()
    assert rows(monitoring.stored_findings(spark, watch)) == again
    report = monitoring.monitor(spark, {"t": watch}, fail_fast=True)
    assert rows(report.where("check != 'latency'"), "check", "subject", "value") == again


def test_retired_writes_lose_their_profiles(spark, tmp_path):
    root = str(tmp_path / "t")
    watch = monitoring.Watch(None, ["id"], stored=root)
    for n in range(3):
        publish(spark.range(n + 1), root, profile=True)
        monitoring.stored_findings(spark, watch)
    retire(spark, root, keep=1, min_age_s=0)
    left = sorted(p.name for p in (tmp_path / "t" / "_profiles").iterdir() if not p.name.startswith("."))
    assert len(left) == 2 and left[0].startswith("000000000003-")
    assert rows(table_profile(spark, root)) == [("id", 3, 0, "0", "2")]
