"""Types of text columns found in the pass that writes them: a lattice of types that any two parts of the data can merge."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions import column

# What a value can be read as, one bit each. The type of a column follows from the bits that occur in it.
WHOLE, LONG, DOUBLE, BOOLEAN, DATE, TIMESTAMP, TEXT = (1 << i for i in range(7))
# Marks a column of which no value is known yet: any type fits it.
UNKNOWN = {"unknown": True}

_WHOLE_NUMBER = r"^[-+]?[0-9]+$"
_NUMBER = r"^(NaN|[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?)$"
_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?(Z|[-+][0-9]{2}:?[0-9]{2})?$"

# From the narrowest: the first type whose bits cover those seen.
_TYPES = (
    (WHOLE, T.IntegerType()),
    (WHOLE | LONG, T.LongType()),
    (WHOLE | LONG | DOUBLE, T.DoubleType()),
    (BOOLEAN, T.BooleanType()),
    (DATE, T.DateType()),
    (DATE | TIMESTAMP, T.TimestampType()),
)


def kind(value: Column) -> Column:
    """The bit of one text value; 0 for NULL and blanks. Whole numbers beyond a long are text, as a double would change them."""
    whole = F.when(value.try_cast("int").isNotNull(), WHOLE).when(value.try_cast("long").isNotNull(), LONG).otherwise(TEXT)
    return (
        F.when(value.isNull() | (F.trim(value) == ""), 0)
        .when(value.rlike(_WHOLE_NUMBER), whole)
        .when(value.rlike(_NUMBER), DOUBLE)
        .when(F.lower(value).isin("true", "false"), BOOLEAN)
        .when(value.rlike(_DAY) & value.try_cast("date").isNotNull(), DATE)
        .when(value.rlike(_MOMENT) & value.try_cast("timestamp").isNotNull(), TIMESTAMP)
        .otherwise(TEXT)
    )


def kinds(df: DataFrame) -> list[Column]:
    """Aggregates of the text columns: the bits that occur, NULLs and blanks of each. Bits merge by "or", counts by adding up."""
    found = []
    for i, field in enumerate(df.schema.fields):
        if isinstance(field.dataType, T.StringType):
            value = column(field.name)
            found += [
                F.bit_or(kind(value)).alias(f"kind_{i}"),
                F.count_if(value.isNull()).alias(f"nulls_{i}"),
                F.count_if(F.trim(value) == "").alias(f"blanks_{i}"),
            ]
    return found


def bits(kind_of: T.DataType) -> int:
    """The bits of a type; text for types outside the lattice."""
    return next((mask for mask, known in _TYPES if known == kind_of), TEXT)


def type_of(mask: int) -> T.DataType:
    return next((known for covered, known in _TYPES if mask | covered == covered), T.StringType())


def join(*fields: T.StructField) -> T.StructField:
    """The narrowest field that holds the values of all; equal types outside the lattice stay as they are."""
    name = fields[0].name
    known = [f for f in fields if not f.metadata.get("unknown")]
    if not known:
        return fields[0]
    if all(f.dataType == known[0].dataType for f in known):
        return T.StructField(name, known[0].dataType)
    mask = 0
    for f in known:
        mask |= bits(f.dataType)
    return T.StructField(name, type_of(mask))


def join_schemas(*schemas: T.StructType) -> T.StructType:
    """All columns in order of their first appearance, each with the join of its types."""
    fields: dict[str, list[T.StructField]] = {}
    for schema in schemas:
        for f in schema.fields:
            fields.setdefault(f.name, []).append(f)
    return T.StructType([join(*own) for own in fields.values()])


def decided(df: DataFrame, found: Mapping[str, int], at_least: Mapping[str, T.DataType] | None = None) -> T.StructType:
    """The schema of ``df`` with its text columns typed by ``found``, the values of ``kinds``.

    A column named in ``at_least`` gets a type that holds that one too, so that it does not depend on the values that came.
    """
    fields = []
    for i, field in enumerate(df.schema.fields):
        if not isinstance(field.dataType, T.StringType):
            fields.append(field)
            continue
        mask, floor = found[f"kind_{i}"] or 0, (at_least or {}).get(field.name)
        if floor is not None:
            mask |= bits(floor)
        known = type_of(mask) if mask else T.StringType()
        fields.append(T.StructField(field.name, known, metadata=None if mask else UNKNOWN))
    return T.StructType(fields)


def typed(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """``value`` as ``target``, which its lattice type fits into; blanks of a text that becomes another type are NULL."""
    return value if source == target else value.try_cast(target)
