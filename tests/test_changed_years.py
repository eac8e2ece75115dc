"""Facts rebuilt for changed years only."""

import pytest
from conftest import SMALL, rows
from pyspark.sql import functions as F

from stratalake.plans import changed_years, literacy, standin
from stratalake.plans import literacy_tables as tables
from stratalake.plans.catalog import CLEANED
from stratalake.operators.clean import clean
from stratalake.sources import Conflict, publish, read_parquet, snapshot, write_parquet

SCHEMA = "ano int, k long, v double"


def frame(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def joined(left, right):
    return left.join(right.withColumnRenamed("v", "w"), ["ano", "k"], "left")


def update(spark, root, left, right, definition="1", build=joined):
    sources = {"left": changed_years.Source(left, "ano"), "right": changed_years.Source(right, "ano", ("ano", "k", "v"))}
    return changed_years.update_by_year(spark, root, "ano", sources, build, definition)


def versions(spark, root):
    return {p.partition: p.version for p in snapshot(spark, root).parts}


def read(spark, root):
    return rows(read_parquet(spark, root), "ano", "k", "v", "w")


def test_only_changed_years_are_built(spark, tmp_path):
    root = str(tmp_path / "fact")
    left = [(2023, 1, 1.0), (2024, 1, 2.0), (2024, 2, None), (2025, 1, 3.0), (None, 7, 1.0)]
    right = [(2023, 1, 9.0), (2025, 1, 8.0)]
    first = update(spark, root, frame(spark, *left), frame(spark, *right))
    assert first == changed_years.Rebuilt(5, (None, 2023, 2024, 2025), ())
    before = versions(spark, root)
    # Nothing changed, rows in another order and other files.
    again = update(spark, root, frame(spark, *left[::-1]).repartition(3), frame(spark, *right))
    assert again == changed_years.Rebuilt(0, (), ()) and snapshot(spark, root).number == 1
    # A target changes 2023, 2024 leaves, 2026 comes, the year NULL gets another row.
    left = [(2023, 1, 1.0), (2025, 1, 3.0), (2026, 5, 0.5), (None, 7, 1.0), (None, 7, 1.0)]
    right = [(2023, 1, 9.5), (2025, 1, 8.0)]
    third = update(spark, root, frame(spark, *left), frame(spark, *right))
    assert third == changed_years.Rebuilt(4, (None, 2023, 2026), (2024,))
    after = versions(spark, root)
    assert set(after) == {"ano=2023", "ano=2025", "ano=2026", "ano=__HIVE_DEFAULT_PARTITION__"}
    assert after["ano=2025"] == before["ano=2025"] and after["ano=2023"] != before["ano=2023"]
    assert read(spark, root) == rows(joined(frame(spark, *left), frame(spark, *right)), "ano", "k", "v", "w")


def test_a_year_that_gives_no_rows_any_more_goes(spark, tmp_path):
    root = str(tmp_path / "fact")
    right = frame(spark, (2023, 1, 9.0), (2024, 1, 9.0))
    update(spark, root, frame(spark, (2023, 1, 1.0), (2024, 1, 1.0)), right)
    # The targets of 2023 are still there.
    done = update(spark, root, frame(spark, (2024, 1, 1.0)), right)
    assert done.built == (2023,) and done.rows == 0
    assert read(spark, root) == [(2024, 1, 1.0, 9.0)]
    done = update(spark, root, frame(spark), frame(spark))
    assert done.removed == (2023, 2024) and read(spark, root) == []
    assert update(spark, root, frame(spark), frame(spark)).rows == 0


def test_another_definition_or_layout_builds_all(spark, tmp_path):
    root = str(tmp_path / "fact")
    left, right = frame(spark, (2023, 1, 1.0), (2024, 1, 1.0)), frame(spark)
    publish(joined(left, right), root)
    assert update(spark, root, left, right).rows == 2
    assert update(spark, root, left, right, definition="2").rows == 2
    assert update(spark, root, left, right, definition="2").rows == 0
    # Published by another writer: its notes are gone, so are its years.
    publish(joined(left, right).where("ano = 2023"), root, "ano", notes={})
    assert update(spark, root, left, right, definition="2").rows == 2


def test_an_update_that_fails_or_comes_late_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "fact")
    left, right = frame(spark, (2023, 1, 1.0), (2024, 1, 1.0)), frame(spark)
    update(spark, root, left, right)
    changed = frame(spark, (2023, 1, 1.0), (2024, 1, 2.0))
    lost = F.when(F.col("ano") == 2024, F.raise_error(F.lit("lost"))).otherwise(F.col("v"))
    with pytest.raises(Exception, match="lost"):
        update(spark, root, changed, right, build=lambda left, right: joined(left.withColumn("v", lost), right))

    def late(left, right):
        publish(joined(left, right).limit(0), root, "ano", how="append")
        return joined(left, right)

    with pytest.raises(Conflict):
        update(spark, root, changed, right, build=late)
    assert rows(read_parquet(spark, root), "ano", "v") == [(2023, 1.0), (2024, 1.0)]
    assert update(spark, root, changed, right).built == (2024,)


def test_fingerprints_tell_rows_apart(spark):
    def prints(*values):
        found = changed_years.fingerprints(changed_years.Source(frame(spark, *values), "ano")).collect()
        return {r["year"]: r["fingerprint"] for r in found}

    base = prints((2023, 1, 1.0), (2023, 2, None))
    assert base == prints((2023, 2, None), (2023, 1, 1.0))
    others = [prints((2023, 1, 1.0)), prints((2023, 1, None), (2023, 2, 1.0)), prints((2023, 1, 1.0), (2023, 2, None), (2023, 2, None))]
    assert base not in others


def test_gold_by_years_equals_gold_whole(spark, tmp_path):
    whole = literacy.Layers("", str(tmp_path / "silver"), str(tmp_path / "whole"))
    by_year = literacy.Layers("", whole.silver, str(tmp_path / "by_year"))
    for spec in (*tables.CLEANED_BATCH, tables.TS_ALUNO):
        write_parquet(clean(standin.raw(spark, SMALL, spec.name), CLEANED[spec.name]), f"{whole.silver}/{spec.name}")
    literacy.run_gold(spark, whole)
    first = changed_years.update_gold(spark, by_year)
    for name in ("fato_indicador", "fato_indicador_uf", "fato_aluno_agregado", "dim_uf"):
        want = read_parquet(spark, f"{whole.gold}/{name}")
        assert rows(read_parquet(spark, f"{by_year.gold}/{name}").select(*want.columns)) == rows(want)
    again = changed_years.update_gold(spark, by_year)
    assert first["fato_indicador"].rows > 0 and again["fato_indicador"] == again["fato_aluno_agregado"] == changed_years.Rebuilt(0, (), ())
