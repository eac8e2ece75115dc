"""Measures of a run held against those of earlier runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions import column

# Makes the median distance from the median comparable with a standard deviation.
NORMAL = 1.4826


def _median(values: Column) -> Column:
    """Median of an array; NULL if it is empty."""
    ordered, n = F.array_sort(values), F.size(values)
    lower, upper = (F.get(ordered, F.floor(x).cast("int")) for x in ((n - 1) / 2, n / 2))
    return F.when(n > 0, (lower + upper) / F.lit(2.0))


def against_past(
    df: DataFrame,
    series: Sequence[str],
    order: Sequence[str],
    measure: str,
    runs: int = 30,
    least: int = 5,
    tolerance: float = 5.0,
    floor: float = 0.1,
    falls_too: bool = True,
) -> DataFrame:
    """Every row with ``usual``, ``spread`` and ``earlier`` of the up to ``runs`` rows before it in its series, and whether it is ``unusual``.

    ``usual`` is the median of the earlier measures, ``spread`` their median distance from it, made comparable with a standard
    deviation, but at least the share ``floor`` of ``usual``: one jump in the past changes neither by much. A row is unusual
    if it is more than ``tolerance`` spreads away, or above, unless ``falls_too``. Fewer than ``least`` earlier measures judge
    nothing, and neither does or is judged a NULL. ``order`` should tell the rows of a series apart. A frame holds ``runs`` numbers at
    most, however long the series.
    """
    value = column(measure).cast("double")
    frame = Window.partitionBy(*map(column, series)).orderBy(*map(column, order)).rowsBetween(-runs, -1)
    judged = df.withColumn("_past", F.collect_list(value).over(frame)).withColumn("usual", _median(F.col("_past")))
    distances = F.transform("_past", lambda x: F.abs(x - F.col("usual")))
    away = value - F.col("usual")
    far = (F.abs(away) if falls_too else away) > tolerance * F.col("spread")
    return (
        judged.withColumn("spread", F.greatest(NORMAL * _median(distances), floor * F.abs("usual")))
        .withColumn("earlier", F.size("_past"))
        .withColumn("unusual", (F.col("earlier") >= least) & F.coalesce(far, F.lit(False)))
        .drop("_past")
    )
