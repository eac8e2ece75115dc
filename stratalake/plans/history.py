"""Monitoring reports kept from run to run, and volume and latency held against earlier runs."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions import column
from stratalake.operators.history import against_past
from stratalake.plans.monitoring import REPORT_SCHEMA, Watch, monitor
from stratalake.sources.published import is_published, publish, read_table

SERIES = ("dataset", "check", "subject")
ORDER = ("at", "run")


def record(report: DataFrame, root: str, run: str, at: dt.datetime) -> int:
    """Append a report to the findings at ``root`` as those of ``run``; nothing that is there changes."""
    kept = report.withColumns({"run": F.lit(run), "at": F.lit(at)})
    return publish(kept, root, how="append").rows


def judge(findings: DataFrame, **limits) -> DataFrame:
    """Kept findings with alerts where volume or latency is far from earlier runs, see ``against_past`` for ``limits``.

    Added are usual_value and usual_s, the medians before the run. A volume may jump or fall, a latency only jump. Alerts that the
    run itself gave stay; a row that is an alert for its past says so in its message, unless it has one.
    """
    volume = column("check") == "volume"
    by_value = against_past(findings, SERIES, ORDER, "value", **limits)
    by_value = by_value.withColumnsRenamed({"usual": "usual_value", "unusual": "_volume"}).drop("spread", "earlier")
    both = against_past(by_value, SERIES, ORDER, "elapsed_s", falls_too=False, **limits)
    both = both.withColumnsRenamed({"usual": "usual_s", "unusual": "_slow"}).drop("spread", "earlier")
    timed = volume | (column("check") == "latency")
    odd = F.concat_ws(", ", F.when(volume & F.col("_volume"), "volume"), F.when(timed & F.col("_slow"), "latency"))
    changed = odd != ""
    message = F.when(changed, F.coalesce("message", F.concat(odd, F.lit(" unlike earlier runs")))).otherwise(F.col("message"))
    return both.withColumns({"severity": F.when(changed, "alert").otherwise(F.col("severity")), "message": message}).drop("_volume", "_slow")


def monitor_and_keep(
    spark: SparkSession, watches: Mapping[str, Watch], root: str, at: dt.datetime | None = None, limits: Mapping | None = None, **options
) -> DataFrame:
    """``monitor``, its findings kept at ``root`` and judged by those of earlier runs; the rows of this run."""
    run = uuid.uuid4().hex
    record(monitor(spark, watches, **options), root, run, at or dt.datetime.now(dt.timezone.utc))
    return judge(kept_findings(spark, root), **(limits or {})).where(column("run") == run)


def kept_findings(spark: SparkSession, root: str) -> DataFrame:
    """All kept findings; none if no run was kept."""
    if not is_published(spark, root):
        return spark.createDataFrame([], f"{REPORT_SCHEMA}, run string, at timestamp")
    return read_table(spark, root)
