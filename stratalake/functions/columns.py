"""Column expressions. All are built-in functions, so they stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def column(name: str) -> Column:
    """The column called ``name``, also when the name holds dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def lenient_cast(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast that gives NULL where the value does not fit, also when the session runs in ANSI mode.

    Text with a fraction loses it when it becomes a whole number ("12.7" gives 12), just as a double does.
    """
    if source == target:
        return value
    number = value.try_cast(target)
    if isinstance(source, T.StringType) and isinstance(target, _WHOLE_NUMBERS):
        # Only values that are no plain number come to the pattern.
        led = F.regexp_replace(value, r"^(\s*[-+]?)\.(?=\d)", "$10.")
        whole = F.regexp_replace(led, r"(\d)\.\d*(\s*)$", "$1$2").try_cast(target)
        number = F.coalesce(number, whole)
    return number


def normalise_code(value: Column) -> Column:
    """Code without surrounding blanks, in upper case."""
    return F.upper(F.trim(value))


def decode(code: Column, labels: Mapping[int, str], default: str) -> Column:
    """Label of a code; unknown codes and NULL get ``default``."""
    cases = [F.when(code == F.lit(key), F.lit(label)) for key, label in labels.items()]
    return F.coalesce(*cases, F.lit(default))


def target_of_year(year: Column, prefix: str, years: Iterable[int]) -> Column:
    """Of the columns ``<prefix><year>``, the one the row's own year names; NULL outside ``years``."""
    cases = [F.when(year == F.lit(y), column(f"{prefix}{y}").try_cast("double")) for y in years]
    return F.coalesce(*cases)


def gap(realised: Column, target: Column) -> Column:
    """Realised minus target. A missing target gives a missing gap, never zero."""
    return realised - target
