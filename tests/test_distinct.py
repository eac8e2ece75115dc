"""Distinct rows by digests."""

import re

import pytest
from conftest import SMALL, plan_of, rows
from hypothesis import HealthCheck, given, settings as limits, strategies as st
from pyspark.sql import functions as F

from stratalake.operators.clean import clean, clean_stored
from stratalake.operators.distinct import _tasks, distinct_in_tasks, distinct_rows
from stratalake.plans import literacy_tables as tables
from stratalake.plans import standin
from stratalake.sources import read_parquet, write_parquet

SCHEMA = "k int, a string, b string, x double"


def same_for_all(df):
    """Digests that tell no rows apart."""
    return F.lit(1).cast("long"), F.lit(2).cast("long")


def few(df):
    """Digests that many different rows share."""
    return F.coalesce(F.col("k"), F.lit(0)).cast("long") % 2, F.lit(2).cast("long")


@limits(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(
    st.sampled_from([None, 1, 2, 3]), st.sampled_from([None, "", "u"]), st.sampled_from([None, "", "u"]),
    st.sampled_from([None, 0.0, -0.0, 1.5, float("nan")]),
), max_size=25), st.sampled_from([None, same_for_all, few]), st.sampled_from([0, 1, 1000]))
def test_equals_drop_duplicates(spark, values, digests, most):
    df = spark.createDataFrame(values, SCHEMA)
    made = distinct_rows(df, most_repeated=most, **({"digests": digests} if digests else {}))
    show = [F.col("k"), F.col("a"), F.col("b"), (F.col("x") + 0.0).cast("string")]
    assert made.columns == df.columns
    assert rows(made.select(*show)) == rows(df.dropDuplicates().select(*show))


def test_nulls_in_other_places_are_other_digests(spark):
    df = spark.createDataFrame([(1, None, "u", 1.0), (1, "u", None, 1.0)], SCHEMA)
    assert "Join" not in plan_of(distinct_rows(df)) and distinct_rows(df).count() == 2


def test_a_third_of_all_rows_may_be_copies(spark, tmp_path):
    copies = spark.range(10_000).select(F.lit(1).cast("int").alias("k"), F.lit("a").alias("a"), F.lit("b").alias("b"), F.lit(1.0).alias("x"))
    others = spark.range(20_000).select((F.col("id") + 2).cast("int").alias("k"), F.lit("a").alias("a"), F.lit("b").alias("b"), F.lit(1.0).alias("x"))
    write_parquet(copies.unionByName(others), str(tmp_path / "t"))
    assert distinct_rows(read_parquet(spark, str(tmp_path / "t"))).count() == 20_001


def test_clashing_columns_are_refused(spark):
    with pytest.raises(ValueError, match="_digest_1"):
        distinct_rows(spark.range(1).withColumnRenamed("id", "_Digest_1"))


def test_unique_rows_are_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "bronze")
    write_parquet(standin.raw(spark, SMALL, "ts_aluno"), path)
    raw = read_parquet(spark, path)
    made = clean_stored(raw, tables.TS_ALUNO)
    # One branch without any exchange but the broadcast, the other compares the repeated rows alone.
    plan = plan_of(made)
    assert rows(made) == rows(clean(raw, tables.TS_ALUNO))
    assert "LeftAnti, BuildRight" in plan and len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert plan.index("LeftAnti, BuildRight") < plan.index("Exchange hashpartitioning")



@limits(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(
    st.sampled_from([None, 1, 2, 3]), st.sampled_from([None, "", "u"]), st.sampled_from([None, "", "u"]),
    st.sampled_from([None, 0.0, -0.0, 1.5, float("nan")]),
), max_size=25), st.sampled_from([1, 4, 1000]), st.sampled_from([0, 2, 1000]))
def test_tasks_equal_drop_duplicates(spark, values, rows_per_task, hot_rows):
    df = spark.createDataFrame(values, SCHEMA)
    made = distinct_in_tasks(df, rows_per_task, hot_rows)
    show = [F.col("k"), F.col("a"), F.col("b"), (F.col("x") + 0.0).cast("string")]
    assert made.schema == df.schema
    assert rows(made.select(*show)) == rows(df.dropDuplicates().select(*show))


def student_rows(spark, n):
    """Microdata with ``n`` students, each delivered twice."""
    schema = tables.TS_ALUNO.schema
    twice = spark.range(2 * n).select((F.col("id") % n).alias("ID_ALUNO"))
    return twice.select(*[
        F.col("ID_ALUNO").cast(f.dataType).alias(f.name) if f.name in ("ID_ALUNO", "CO_MUNICIPIO") else F.lit("1").cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def test_cleaning_gathers_no_wide_rows_before_the_shuffle(spark):
    """The distinct rows of a whole part of a scan would be in the memory of its task."""
    made = clean(student_rows(spark, 500), tables.TS_ALUNO)
    plan = plan_of(made)
    assert plan.count("Exchange") == 1 and "Aggregate" not in plan[plan.index("Exchange"):]
    assert made.count() == 500


def test_tasks_follow_the_rows(spark):
    df = student_rows(spark, 500)
    for per_task, tasks in ((400, 3), (100, 10), (10, 100), (4, 200), (1, 200)):
        made = distinct_in_tasks(df, per_task)
        assert re.search(rf"Exchange hashpartitioning\(_dealt#\d+L, {tasks}\)", plan_of(made))
        assert made.rdd.getNumPartitions() == tasks and made.count() == 500


def test_tasks_grow_again_beyond_the_direct_writes():
    assert [_tasks(n, 10) for n in (0, 1, 2000, 2001, 12_000, 12_001, 10**9)] == [1, 1, 200, 200, 200, 1201, 50_000]


def test_a_row_with_very_many_copies_is_combined_before_the_shuffle(spark):
    few = student_rows(spark, 5000)
    many = spark.range(30_000).crossJoin(student_rows(spark, 1).limit(1).withColumn("CO_UF", F.lit(2))).select(*few.columns)
    made = distinct_in_tasks(few.unionByName(many), 2000)
    even, hot = plan_of(made).split("Exchange hashpartitioning(")[1:]
    assert even.startswith("_dealt") and "HashAggregate" in hot
    assert made.count() == 5001
    biggest = made.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).max()
    assert biggest < 2000


def test_columns_may_have_the_name_of_the_dealing_column(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (1, 3)], "_Dealt int, _dealt_ int")
    assert rows(distinct_in_tasks(df)) == [(1, 2), (1, 3)]
