import dataclasses

import pytest
from conftest import SMALL, plan_of, rows
from pyspark.sql import types as T

from stratalake.operators.clean import SpecError, clean, presence_split
from stratalake.plans import literacy_tables as tables
from stratalake.plans import standin
from stratalake.specs import TableSpec

UF_COLUMNS = "ano string, sigla_uf string, serie string, rede string, taxa_alfabetizacao string, media_portugues string"


def uf(spark, *records):
    return spark.createDataFrame(list(records), UF_COLUMNS)


def test_duplicates_are_judged_before_normalising(spark):
    df = uf(spark, ("2024", " ro", "2", "5", "50", "700"), ("2024", "RO", "2", "5", "50", "700"))
    assert rows(clean(df, tables.UF), "sigla_uf") == [("RO",), ("RO",)]


def test_exact_copies_collapse(spark):
    record = ("2024", "RO", "2", "5", "50", "700")
    assert rows(clean(uf(spark, record, record, record), tables.UF)) == [(2024, "RO", 2, 5, 50.0, 700.0)]


def test_rows_without_a_required_key_go(spark):
    df = uf(spark, ("2024", None, "2", "5", "50", "700"), (None, "RO", "2", "5", "50", "700"),
            ("2024", "AC", None, None, None, None))
    assert rows(clean(df, tables.UF)) == [(2024, "AC", None, None, None, None)]


def test_a_key_may_become_null_in_the_cast_after_the_check(spark):
    df = uf(spark, ("n/d", "RO", "2", "Municipal", "50", "700"))
    assert rows(clean(df, tables.UF)) == [(None, "RO", 2, None, 50.0, 700.0)]


def test_text_network_of_target_tables_is_kept_but_cast_in_the_national_one(spark):
    national = spark.createDataFrame([("2024", "Municipal", "50", "x")], "ano string, rede string, "
                                     "taxa_alfabetizacao string, extra string")
    assert rows(clean(national, tables.META_BRASIL)) == [(2024, None, 50.0, "x")]
    state = spark.createDataFrame([("2024", " ac", "Pública", "50")], "ano string, sigla_uf string, rede string, "
                                  "taxa_alfabetizacao string")
    assert rows(clean(state, tables.META_POR_UF)) == [(2024, "AC", "Pública", 50.0)]


def test_microdata_table_is_renamed_but_its_codes_stay_raw(spark):
    df = spark.createDataFrame([("2025", "5300108", " ro", "61.5", 2, 3)], "NU_ANO_AVALIACAO string, "
                               "CO_MUNICIPIO string, SG_UF string, PC_ALUNO_ALFABETIZADO string, TP_SERIE int, "
                               "ID_TIPO_REDE int")
    got = clean(df, tables.TS_MUNICIPIO)
    assert got.columns == ["ano", "id_municipio", "sigla_uf", "PC_ALUNO_ALFABETIZADO", "TP_SERIE", "ID_TIPO_REDE"]
    assert rows(got) == [(2025, 5300108, " ro", 61.5, 2, 3)]


def test_renaming_onto_an_existing_column_is_refused(spark):
    df = spark.createDataFrame([(2025, 2024, 1)], "NU_ANO int, ANO int, CO_UF int")
    spec = TableSpec("t", required=("CO_UF",), renames={"NU_ANO": "ano"})
    with pytest.raises(SpecError, match="ano"):
        clean(df, spec)


def test_missing_columns_are_named(spark):
    with pytest.raises(SpecError, match="sigla_uf"):
        clean(spark.createDataFrame([(1,)], "ano int"), tables.UF)


def test_column_names_with_dots(spark):
    df = spark.createDataFrame([("1", "x"), ("1", "x"), (None, "y")], "`a.b` string, c string")
    spec = TableSpec("t", required=("a.b",), casts={"a.b": T.IntegerType()}, renames={"c": "d.e"})
    assert rows(clean(df, spec)) == [(1, "x")]


def test_cleaning_clean_rows_changes_nothing(spark):
    once = clean(standin.raw(spark, SMALL, "municipio"), tables.MUNICIPIO).dropDuplicates()
    assert rows(clean(once, tables.MUNICIPIO)) == rows(once)


def test_students_keep_absentees_and_all_columns(spark):
    raw = standin.raw(spark, SMALL, "ts_aluno")
    got = clean(raw, tables.TS_ALUNO)
    assert got.columns == tables.TS_ALUNO.schema.fieldNames()
    present, absent = presence_split(got, "IN_PRESENCA_LP").first()
    assert present > 0 and absent > 0
    assert present + absent + got.where("IN_PRESENCA_LP IS NULL").count() == got.count()


def test_keys_are_checked_in_the_scan_and_copies_combined_before_the_shuffle(spark):
    lineitem = standin.table(spark, SMALL, "lineitem")
    spec = dataclasses.replace(tables.TS_ALUNO, required=("l_orderkey", "l_partkey"), codes=("l_returnflag",))
    plan = plan_of(clean(lineitem, spec))
    assert "IsNotNull(l_orderkey)" in plan and "IsNotNull(l_partkey)" in plan
    assert plan.count("Exchange") == 1 and plan.count("HashAggregate") == 2
