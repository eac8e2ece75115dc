"""What a table looks like and how it is cleaned."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    """Cleaning rules and keys of one table.

    ``required``, ``casts``, ``codes`` and ``renames`` use the raw column names; ``business_key`` uses the
    cleaned ones. ``schema`` is None where the full header is not known and the reader infers it. ``wide`` marks
    tables whose rows are too wide to be shuffled whole for the sake of a few duplicates.
    """

    name: str
    required: tuple[str, ...]
    casts: Mapping[str, T.DataType] = field(default_factory=dict)
    codes: tuple[str, ...] = ()
    renames: Mapping[str, str] = field(default_factory=dict)
    business_key: tuple[str, ...] = ()
    schema: T.StructType | None = None
    file_name: str | None = None
    separator: str = ","
    wide: bool = False
