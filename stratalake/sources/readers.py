"""Batch readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stratalake.sources.files import Files
from stratalake.sources.published import is_published, read_table


def read_csv(
    spark: SparkSession,
    path: str,
    separator: str = ",",
    schema: T.StructType | None = None,
    multi_line: bool = False,
    unreadable: str | None = None,
) -> DataFrame:
    """CSV file or folder with a header.

    With ``schema`` there is no inference scan, and a header whose names or order differ from it is an
    error rather than values under wrong names. Without it the types are inferred, at the price of
    reading the text twice, and every file of a folder is held against the inferred header. A doubled quote inside
    quotes is a quote. ``multi_line`` allows line breaks inside quotes; such files are not split over tasks.
    ``unreadable`` names a column to add, which keeps the whole line where a value does not fit the type of ``schema``.
    """
    reader = spark.read.option("header", True).option("sep", separator).option("escape", '"').option("multiLine", multi_line)
    if schema is None:
        schema = reader.option("inferSchema", True).csv(path).schema
        reader = reader.option("inferSchema", False)
    if unreadable:
        schema = T.StructType([*schema.fields, T.StructField(unreadable, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", unreadable)
    return reader.option("enforceSchema", False).schema(schema).csv(path)


def _text_of(spark: SparkSession, paths: str | list[str], header: str, separator: str, multi_line: bool) -> DataFrame:
    """CSV files as text, by the names in the header of ``header``; files with another one are an error."""
    options = {"header": True, "sep": separator, "escape": '"', "multiLine": multi_line}
    names = spark.read.options(**options).csv(header).columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return spark.read.options(**options, enforceSchema=False).schema(schema).csv(paths)


def read_csv_text(spark: SparkSession, path: str, separator: str = ",", multi_line: bool = False) -> DataFrame:
    """CSV file or folder with a header, every value as the text it is. Only the header is read to open it."""
    return _text_of(spark, path, path, separator, multi_line)


def csv_variants(spark: SparkSession, folder: str, separator: str = ",", multi_line: bool = False) -> list[DataFrame]:
    """The CSV files of a folder as text, one frame for the files of each header, each read by its own names and order.

    Of every file the first line is read on the driver. Empty files have no header and no rows.
    """
    files = Files(spark)
    names = sorted(n for n in files.names(folder) if not n.startswith((".", "_")))
    by_header: dict[str, list[str]] = {}
    for name in names:
        by_header.setdefault(files.first_line(f"{folder.rstrip('/')}/{name}").lstrip("\ufeff").strip(), []).append(f"{folder.rstrip('/')}/{name}")
    by_header.pop("", None)
    return [_text_of(spark, paths, paths[0], separator, multi_line) for paths in by_header.values()]


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Table by its last published state, or plain Parquet; partition columns come back from the folder names."""
    if is_published(spark, path):
        return read_table(spark, path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)
