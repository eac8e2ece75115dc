from conftest import plan_of, rows

from stratalake.operators import report
from stratalake.plans import literacy

FACT = "sigla_uf string, ano int, taxa double, m_2024 double, m_2025 double"


def gaps(spark, *records):
    return report.with_gap(spark.createDataFrame(list(records), FACT), "taxa", "m_", (2024, 2025), "ano")


def test_a_missing_target_never_counts_as_zero(spark):
    df = gaps(spark, ("AC", 2024, 51.0, None, 60.0), ("SP", 2024, 51.0, 50.0, None), ("SP", 2025, 51.0, 50.0, 52.5))
    assert rows(report.target_hit(df), "sigla_uf", "ano", "target", "gap", "hit") == [
        ("AC", 2024, None, None, None), ("SP", 2024, 50.0, 1.0, 1), ("SP", 2025, 52.5, -1.5, 0)]


def test_meeting_the_target_exactly_is_a_hit(spark):
    assert rows(report.target_hit(gaps(spark, ("SP", 2024, 50.0, 50.0, None))), "hit") == [(1,)]


def test_top_and_bottom_skip_targetless_states_and_break_ties_by_key(spark):
    df = gaps(spark, ("A", 2024, 10.0, 0.0, None), ("B", 2024, 10.0, 0.0, None), ("C", 2024, 5.0, 0.0, None),
              ("D", 2024, 99.0, None, None), ("A", 2025, 1.0, None, 0.0))
    got = report.top_bottom(df, "sigla_uf", "ano", 2)
    assert rows(got, "ano", "ranking", "position", "sigla_uf", "gap") == [
        (2024, "bottom", 1, "C", 5.0), (2024, "bottom", 2, "A", 10.0),
        (2024, "top", 1, "A", 10.0), (2024, "top", 2, "B", 10.0),
        (2025, "bottom", 1, "A", 1.0), (2025, "top", 1, "A", 1.0)]
    assert plan_of(got).count("WindowGroupLimit") == 4


def test_regions(spark):
    df = gaps(spark, ("AC", 2024, 40.0, 50.0, None), ("RO", 2024, 60.0, 50.0, None), ("SP", 2024, 60.0, None, None),
              ("XX", 2024, 1.0, 2.0, None))
    got = report.by_region(df, literacy.state_regions(spark), "sigla_uf", "ano", "taxa")
    assert rows(got) == [("Norte", 2024, 50.0, 50.0, 0.0, 2, 1), ("Sudeste", 2024, 60.0, None, None, 0, 0),
                         ("Unknown", 2024, 1.0, 2.0, -1.0, 1, 0)]


def test_national_kpis(spark):
    national = gaps(spark, ("BR", 2024, 55.0, 60.0, None), ("BR", 2025, 59.2, 60.0, None))
    students = spark.createDataFrame([(1, 2024, 10), (2, 2024, 5)], "id int, ano int, n long")
    got = report.national_kpis(national, students, "ano", "taxa", "n")
    assert rows(got) == [(2024, 55.0, 60.0, -5.0, 15), (2025, 59.2, None, None, None)]


def test_state_table(spark):
    got = report.realised_vs_target(gaps(spark, ("SP", 2024, 51.0, 50.0, None)), "sigla_uf", "ano", "taxa")
    assert got.columns == ["sigla_uf", "ano", "realised", "target", "gap", "hit"]
    assert rows(got) == [("SP", 2024, 51.0, 50.0, 1.0, 1)]


def test_national_gap_covers_rows_with_a_target_only(spark):
    national = gaps(spark, ("BR", 2024, 50.0, None, None), ("BR", 2024, 80.0, 90.0, None))
    students = spark.createDataFrame([(1, 2024, 10)], "id int, ano int, n long")
    assert rows(report.national_kpis(national, students, "ano", "taxa", "n"), "gap") == [(-10.0,)]


def test_a_state_listed_twice_counts_once(spark):
    regions = spark.createDataFrame([("AC", "Norte"), ("AC", "Norte")], "sigla_uf string, region string")
    got = report.by_region(gaps(spark, ("AC", 2024, 40.0, 50.0, None)), regions, "sigla_uf", "ano", "taxa")
    assert rows(got, "region", "with_target") == [("Norte", 1)]
