"""Findings kept from run to run."""

import datetime as dt
import statistics

from conftest import rows
from hypothesis import HealthCheck, given, settings as limits, strategies as st

from stratalake.operators.history import NORMAL, against_past
from stratalake.plans import history, monitoring

SCHEMA = "s string, t int, v double"


def by_hand(values, runs, least, falls_too):
    made = []
    for name in {v[0] for v in values}:
        series = sorted(v for v in values if v[0] == name)
        for i, (_, t, v) in enumerate(series):
            past = [x for _, _, x in series[max(0, i - runs) : i] if x is not None]
            usual = statistics.median(past) if past else None
            spread = max(NORMAL * statistics.median(abs(x - usual) for x in past), 0.1 * abs(usual)) if past else None
            unusual = False
            if len(past) >= least and v is not None:
                away = v - usual
                unusual = (abs(away) if falls_too else away) > 5.0 * spread
            made.append((name, t, v, usual, spread, len(past), unusual))
    return made


@limits(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 60), st.sampled_from([None, 0.0, 1.0, 2.0, 2.5, 40.0, -3.0])),
             max_size=40, unique_by=lambda v: v[:2]),
    st.sampled_from([3, 30]), st.sampled_from([1, 3]), st.booleans())
def test_equals_the_definition(spark, values, runs, least, falls_too):
    df = spark.createDataFrame(values, SCHEMA)
    made = against_past(df, ["s"], ["t"], "v", runs=runs, least=least, falls_too=falls_too)
    key = lambda r: r[:2]
    assert sorted(map(tuple, made.collect()), key=key) == sorted(by_hand(values, runs, least, falls_too), key=key)


def report(spark, volume, seconds):
    found = [("orders", "volume", "rows", volume, "ok" if volume else "alert", seconds, None), ("orders", "nulls", "k", 0, "ok", seconds, None),
             ("total", "latency", None, None, "ok", seconds, None)]
    return spark.createDataFrame(found, monitoring.REPORT_SCHEMA)


def test_jumps_alert_and_old_jumps_do_not_hide_new_ones(spark, tmp_path):
    root = str(tmp_path / "findings")
    assert history.kept_findings(spark, root).count() == 0
    runs = [(100, 1.0), (103, 1.1), (99, 1.0), (500, 1.0), (101, 1.2), (100, 9.0), (0, 1.0), (104, 0.1), (400, 1.0)]
    for i, (volume, seconds) in enumerate(runs):
        assert history.record(report(spark, volume, seconds), root, f"r{i}", dt.datetime(2024, 1, 1 + i)) == 3
    judged = history.judge(history.kept_findings(spark, root), least=3)
    alerts = rows(judged.where("severity = 'alert'"), "run", "dataset", "check", "message")
    late = "latency unlike earlier runs"
    assert alerts == rows(spark.createDataFrame([
        ("r3", "orders", "volume", "volume unlike earlier runs"), ("r5", "orders", "volume", late), ("r5", "total", "latency", late),
        ("r6", "orders", "volume", "volume unlike earlier runs"), ("r8", "orders", "volume", "volume unlike earlier runs"),
    ], "run string, dataset string, check string, message string"))
    assert judged.count() == 27


def test_monitor_keeps_and_judges(spark, tmp_path):
    root = str(tmp_path / "findings")
    size = [20]
    watches = {"t": monitoring.Watch(lambda: spark.range(size[0]), ["id"])}
    for day in range(1, 5):
        first = history.monitor_and_keep(spark, watches, root, dt.datetime(2024, 1, day), {"least": 3, "tolerance": 50.0})
        assert rows(first.where("check = 'volume'"), "severity", "value") == [("ok", 20)]
    size[0] = 2000
    last = history.monitor_and_keep(spark, watches, root, dt.datetime(2024, 1, 5), {"least": 3, "tolerance": 50.0})
    assert rows(last.where("check = 'volume'"), "severity", "value", "usual_value") == [("alert", 2000, 20.0)]
    assert history.kept_findings(spark, root).select("run").distinct().count() == 5
