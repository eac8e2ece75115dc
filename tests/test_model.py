
import pytest
from conftest import plan_of, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratalake.operators import model
from stratalake.operators.clean import SpecError
from stratalake.plans import literacy

MUNICIPIO = "ano int, id_municipio long, serie int, rede int, taxa_alfabetizacao double, media_portugues double"
TARGET = ("ano int, id_municipio long, rede string, taxa_alfabetizacao double, "
          + ", ".join(f"meta_alfabetizacao_{y} double" for y in range(2024, 2031))
          + ", nivel_alfabetizacao int, percentual_participacao double")


def target(spark, *records):
    return spark.createDataFrame([(*r, *([60.0] * 7), 3, 90.0) for r in records], TARGET)


def test_rows_without_a_target_stay_with_nulls(spark):
    realised = spark.createDataFrame([(2024, 1, 2, 2, 50.0, 700.0), (2024, 1, 2, 3, 55.0, 710.0)], MUNICIPIO)
    fact = literacy.fato_indicador(realised, target(spark, (2024, 1, "Municipal", 58.0)))
    assert rows(fact, "rede", "taxa_realizada", "taxa_meta_referencia", "meta_alfabetizacao_2030") == [
        ("Estadual", 50.0, None, None), ("Municipal", 55.0, 58.0, 60.0)]
    assert len(fact.columns) == 15


def test_rows_that_differ_only_in_a_dropped_column_become_one(spark):
    realised = spark.createDataFrame([(2024, 1, 2, 3, 50.0, 700.0), (2024, 1, 5, 3, 50.0, 700.0)], MUNICIPIO)
    assert literacy.fato_indicador(realised, target(spark, (2024, 1, "Municipal", 58.0))).count() == 1


def test_state_fact_casts_the_last_target_and_matches_public_network(spark):
    realised = spark.createDataFrame([(2024, "RO", 2, 5, 50.0, 700.0), (2024, "RO", 2, 1, 40.0, 690.0)],
                                     "ano int, sigla_uf string, serie int, rede int, taxa_alfabetizacao double, "
                                     "media_portugues double")
    metas = ", ".join(f"meta_alfabetizacao_{y} double" for y in range(2024, 2030))
    goals = spark.createDataFrame([(2024, "RO", "Pública", 51.0, *([60.0] * 6), "80.5", 90.0)],
                                  f"ano int, sigla_uf string, rede string, taxa_alfabetizacao double, {metas}, "
                                  "meta_alfabetizacao_2030 string, percentual_participacao double")
    fact = literacy.fato_indicador_uf(realised, goals)
    assert dict(fact.dtypes)["meta_alfabetizacao_2030"] == "double" and len(fact.columns) == 14
    assert rows(fact, "rede", "meta_alfabetizacao_2030") == [("Não classificada", None), ("Pública", 80.5)]


def test_missing_fact_columns_are_named(spark):
    df = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(SpecError, match="measure"):
        model.fact_vs_target(df, df, ["k"], {"measure": "m"}, {})


small = st.one_of(st.none(), st.integers(0, 1))
side = st.lists(st.tuples(small, small), min_size=0, max_size=8)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=side, right=side)
def test_distinct_before_the_join_equals_distinct_after_it(spark, left, right):
    realised = spark.createDataFrame(left, "k int, m int")
    goals = spark.createDataFrame(right, "k int, t int")
    got = model.fact_vs_target(realised, goals, ["k"], {"m": "m"}, {"t": "t"})
    want = realised.join(goals, "k", "left").select("k", "m", "t").distinct()
    assert rows(got) == rows(want)


def test_unique_targets_keep_the_row_count(spark):
    realised = spark.range(200).select((F.col("id") % 20).alias("k"), F.col("id").alias("m"))
    goals = spark.range(0, 20, 3).select(F.col("id").alias("k"), F.lit(1).alias("t"))
    assert model.fact_vs_target(realised, goals, ["k"], {"m": "m"}, {"t": "t"}).count() == 200


def test_a_hot_key_is_split_over_tasks_and_nothing_is_lost(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1",
             spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
             spark__sql__adaptive__advisoryPartitionSizeInBytes="16KB",
             spark__sql__adaptive__coalescePartitions__enabled="false",
             spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="32KB",
             spark__sql__adaptive__skewJoin__skewedPartitionFactor="2")
    n = 60000
    realised = spark.range(0, n, 1, 16).select(
        F.when(F.col("id") < n // 2, F.lit(7)).otherwise(F.col("id")).alias("k"), F.col("id").alias("m"))
    goals = spark.range(0, n, 1, 4).select(F.col("id").alias("k"), (F.col("id") * 2).alias("t"))
    fact = model.fact_vs_target(realised, goals, ["k"], {"m": "m"}, {"t": "t"})
    assert fact.agg(F.count("*"), F.sum("t")).first()[0] == n
    collected = fact.collect()
    assert len(collected) == n and sum(r["k"] == 7 for r in collected) == n // 2 + (7 >= n // 2)
    assert "skew=true" in plan_of(fact)


def test_dimensions_are_distinct_and_sorted(spark):
    df = spark.createDataFrame([("SP",), ("AC",), ("SP",)], "sigla_uf string")
    assert [r[0] for r in literacy.dim_uf(df).collect()] == ["AC", "SP"]


def test_lookup_conflicts_resolve_to_the_smallest_normalised_value(spark):
    municipio = spark.createDataFrame([(1,), (1,), (2,), (3,)], "id_municipio long")
    lookup = spark.createDataFrame([(1, " sp"), (1, "AC "), (2, None), (9, "RO")], "id_municipio long, sigla_uf string")
    got = [tuple(r) for r in literacy.dim_municipio(municipio, lookup).collect()]
    assert got == [(1, "AC"), (2, None), (3, None)]


def test_dimension_join_adds_no_shuffle(spark, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    ids = spark.range(100).select(F.col("id").alias("id_municipio"))
    lookup = ids.withColumn("sigla_uf", F.lit("AC"))
    plan = plan_of(literacy.dim_municipio(ids.union(ids), lookup))
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Exchange rangepartitioning") == 1


STUDENT = ("CO_MUNICIPIO long, NU_ANO_AVALIACAO int, ID_ALUNO long, IN_PRESENCA_LP int, VL_PROFICIENCIA_LP double, "
           "IN_ALFABETIZADO int")


def test_student_aggregate_uses_present_students_and_ignores_missing_scores(spark):
    df = spark.createDataFrame(
        [(1, 2025, 1, 1, 700.005, 1), (1, 2025, 2, 1, None, 0), (1, 2025, 3, 0, 900.0, 1), (1, 2025, 4, None, 900.0, 1),
         (1, 2025, 5, 1, 700.0, 0), (2, 2025, 6, 0, 1.0, 1)], STUDENT)
    assert rows(literacy.fato_aluno_agregado(df)) == [(1, 2025, 700.0, 33.33, 3)]


def test_rounding_is_half_up(spark):
    df = spark.createDataFrame([(1, 2025, i, 1, v, 1) for i, v in enumerate([0.0, 0.25])], STUDENT)
    assert literacy.fato_aluno_agregado(df).first()["proficiencia_media"] == 0.13


def test_presence_filter_reaches_the_scan_and_only_needed_columns_are_read(spark, tmp_path):
    path = str(tmp_path / "students")
    spark.createDataFrame([(1, 2025, 1, 1, 1.0, 1)], STUDENT).withColumn("unused", F.lit("x")).write.parquet(path)
    plan = plan_of(literacy.fato_aluno_agregado(spark.read.parquet(path)))
    assert "EqualTo(IN_PRESENCA_LP,1)" in plan and "unused" not in plan
    assert "partial_avg" in plan and plan.count("Exchange") == 1
