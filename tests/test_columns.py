import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions import decode, gap, lenient_cast, normalise_code, target_of_year
from stratalake.plans import literacy_tables as tables


def cast_all(spark, values, source, target):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], T.StructType(
        [T.StructField("i", T.IntegerType()), T.StructField("v", source)]))
    cast = df.select("i", lenient_cast(F.col("v"), source, target).alias("c")).orderBy("i")
    return [r["c"] for r in cast.collect()]


def test_text_that_is_no_number_gives_null_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert cast_all(spark, ["12", " 12 ", "Municipal", "", None, "99999999999"], T.StringType(), T.IntegerType()) == [
        12, 12, None, None, None, None]


def test_text_with_a_fraction_loses_it(spark):
    values = ["12.7", "-3.9", "5.", "1.2.3", "12.7e3", "7.5 ", ".5", "-.5", "."]
    assert cast_all(spark, values, T.StringType(), T.IntegerType()) == [12, -3, 5, None, None, 7, 0, 0, None]


def test_double_casts(spark):
    assert cast_all(spark, [12.7, None], T.DoubleType(), T.IntegerType()) == [12, None]
    assert cast_all(spark, ["1.5", "x"], T.StringType(), T.DoubleType()) == [1.5, None]


def test_codes_are_trimmed_and_upper_case(spark):
    df = spark.createDataFrame([(" ro ",), ("Sp",), (None,)], "c string")
    assert rows(df.select(normalise_code(F.col("c")))) == [(None,), ("RO",), ("SP",)]


MUNICIPAL = ["Total (Federal, Estadual, Municipal)", "Federal", "Estadual", "Municipal", "Privada",
             "Pública (Estadual e Municipal)", "Pública (Federal, Estadual e Municipal)"]
STATE = ["Total", "Não classificada", "Estadual", "Municipal", "Não classificada", "Pública", "Não classificada"]


@pytest.mark.parametrize("labels, expected", [(tables.MUNICIPAL_NETWORKS, MUNICIPAL), (tables.STATE_NETWORKS, STATE)])
def test_decode(spark, labels, expected):
    codes = [*range(7), 9, None]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "i int, c int")
    decoded = df.select("i", decode(F.col("c"), labels, tables.UNCLASSIFIED).alias("l")).orderBy("i")
    assert [r["l"] for r in decoded.collect()] == expected + ["Não classificada"] * 2


def test_gap_without_target_is_null(spark):
    df = spark.createDataFrame([(51.0, None), (51.0, 50.0)], "r double, t double")
    assert rows(df.select(gap(F.col("r"), F.col("t")))) == [(None,), (1.0,)]


def test_target_of_the_rows_own_year(spark):
    df = spark.createDataFrame(
        [(2024, 1.0, "2.0"), (2025, 1.0, "2.0"), (2025, 1.0, "x"), (2023, 1.0, "2.0"), (None, 1.0, "2.0")],
        "ano int, m_2024 double, m_2025 string")
    got = [r[0] for r in df.select(target_of_year(F.col("ano"), "m_", (2024, 2025))).collect()]
    assert got == [1.0, 2.0, None, None, None]


def test_every_state_has_one_region():
    states = [s for group in tables.REGION_STATES.values() for s in group]
    assert len(states) == len(set(states)) == 27
