import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from stratalake.plans import literacy_tables as tables
from stratalake.session import recommended_settings, work_folder
from stratalake.sources import land_csv, read_csv, read_parquet, write_parquet, write_partitioned


def put(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder / name)


def test_inferred_csv(spark, tmp_path):
    path = put(tmp_path, "uf.csv", "ano,sigla_uf,taxa\n2024,RO,50.5\n2025,,\n")
    df = read_csv(spark, path)
    assert dict(df.dtypes) == {"ano": "int", "sigla_uf": "string", "taxa": "double"}
    assert rows(df) == [(2024, "RO", 50.5), (2025, None, None)]


def test_semicolon_csv_with_declared_schema(spark, tmp_path):
    names = tables.TS_ALUNO.schema.fieldNames()
    values = {"NU_ANO_AVALIACAO": "2025", "SG_UF": "RO", "ID_ALUNO": "777", "VL_PROFICIENCIA_LP": "612.25"}
    path = put(tmp_path, "a.csv", ";".join(names) + "\n" + ";".join(values.get(n, "") for n in names) + "\n")
    df = read_csv(spark, path, ";", tables.TS_ALUNO.schema)
    assert df.schema == tables.TS_ALUNO.schema
    assert rows(df, *values) == [(2025, "RO", 777, 612.25)]


def test_header_in_another_order_is_an_error(spark, tmp_path):
    path = put(tmp_path, "a.csv", "b;a\n1;2\n")
    schema = spark.createDataFrame([], "a int, b int").schema
    with pytest.raises(Exception, match="header"):
        read_csv(spark, path, ";", schema).collect()


def test_declared_schema_needs_no_job_to_open_the_file(spark, tmp_path):
    path = put(tmp_path, "a.csv", "a;b\n1;2\n")
    spark.sparkContext.setJobGroup("open", "open")
    read_csv(spark, path, ";", spark.createDataFrame([], "a int, b int").schema)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("open")
    read_csv(spark, path, ";")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("open")


def test_write_counts_its_rows_and_overwrites(spark, tmp_path):
    path = str(tmp_path / "t")
    assert write_parquet(spark.range(10), path) == 10
    assert write_parquet(spark.range(3), path) == 3
    assert read_parquet(spark, path).count() == 3


@pytest.mark.parametrize("make", [
    lambda s: s.createDataFrame([], "id int, ano int"),
    lambda s: s.createDataFrame([(1, 2024)], "id int, ano int").where("false"),
    lambda s: s.createDataFrame([(1, 2024)], "id int, ano int").where("id > 1").dropDuplicates(),
])
def test_empty_tables_can_be_written(spark, tmp_path, make):
    path, parted = str(tmp_path / "t"), str(tmp_path / "p")
    assert write_parquet(make(spark), path) == 0
    assert read_parquet(spark, path).count() == 0
    assert write_partitioned(make(spark), parted, "ano") == 0


def test_rewriting_one_partition_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 2023), (2, 2024)], "id int, ano int")
    assert write_partitioned(df, path, "ano") == 2
    assert write_partitioned(spark.createDataFrame([(9, 2024)], "id int, ano int"), path, "ano") == 1
    assert rows(read_parquet(spark, path), "id", "ano") == [(1, 2023), (9, 2024)]


def test_a_year_filter_reads_one_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    write_partitioned(spark.range(100).withColumn("ano", (F.col("id") / 50).cast("int") + 2023), path, "ano")
    df = read_parquet(spark, path).where(F.col("ano") == 2024)
    assert df.count() == 50
    plan = plan_of(df)
    assert "PartitionFilters: [isnotnull(ano" in plan and "(ano" in plan.split("PartitionFilters")[1]


def test_a_partition_gets_few_files_and_a_hot_one_is_split(spark, tmp_path, settings):
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB")
    path = tmp_path / "t"
    year = F.when(F.col("id") < 60000, 2024).otherwise(2025 + F.col("id").cast("int") % 5)
    df = spark.range(0, 90000, 1, 32).withColumn("ano", year).withColumn("v", F.xxhash64("id"))
    assert write_partitioned(df, str(path), "ano") == 90000
    files = {d.name: len(list(d.glob("*.parquet"))) for d in path.glob("_data/*/ano=*")}
    assert files["ano=2024"] > 2
    assert all(n <= 8 for year, n in files.items() if year != "ano=2024")


def test_landing_twice_on_one_day_does_not_repeat_rows_and_keeps_other_days(spark, tmp_path):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    put(landing, "a.csv", "id,v\n1,x\n2,y\n")
    put(landing, "b.csv", "id,v\n3,z\n")
    assert land_csv(spark, str(landing), out).rows == 3
    old = read_parquet(spark, out).withColumn("ingest_year", F.lit("2001"))
    write_partitioned(old, out, "ingest_year", "ingest_month", "ingest_day", rebalance=False)
    assert land_csv(spark, str(landing), out).rows == 3
    got = read_parquet(spark, out)
    assert got.groupBy("ingest_year").count().where("count = 3").count() == 2
    assert got.where("_bronze_timestamp IS NULL").count() == 0
    assert rows(got.where("ingest_year > 2001"), "id", "v") == [(1, "x"), (2, "y"), (3, "z")]


def test_ingestion_day_is_utc_whatever_the_session_zone(spark, tmp_path, settings):
    from datetime import datetime, timezone

    from stratalake.sources.writers import ingestion_columns

    for zone in ("Pacific/Kiritimati", "Pacific/Pago_Pago"):
        settings(spark__sql__session__timeZone=zone)
        row = spark.range(1).select(*[c.alias(n) for n, c in ingestion_columns().items()]).first()
        now = datetime.now(timezone.utc)
        assert (row["ingest_year"], row["ingest_month"], row["ingest_day"]) == (
            f"{now:%Y}", f"{now:%m}", f"{now:%d}")


class FakeSession:
    def __init__(self, **settings):
        self.conf = {k.replace("__", "."): v for k, v in settings.items()}


def test_work_folders_are_fresh_and_shared():
    session = FakeSession(spark__checkpoint__dir="hdfs:/shared/", spark__master="yarn")
    one, two = work_folder(session, "x"), work_folder(session, "x")
    assert one != two and one.startswith("hdfs:/shared/x-") and two.startswith("hdfs:/shared/x-")


def test_a_local_session_without_the_setting_gets_a_temporary_folder():
    assert "stratalake-" in work_folder(FakeSession(spark__master="local[8]"), "x")


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(FakeSession(spark__master="yarn"), "x")


def test_settings_follow_the_amount_of_data():
    small, large = recommended_settings(10**9, 64), recommended_settings(100 * 10**12, 8000)
    assert small["spark.sql.shuffle.partitions"] == "64"
    assert large["spark.sql.shuffle.partitions"] == "50000"
    assert int(large["spark.sql.adaptive.advisoryPartitionSizeInBytes"]) == 2 * 10**9
    assert int(large["spark.sql.files.maxPartitionBytes"]) == 1024**3


def test_quotes_separators_and_line_breaks_stay_in_their_field(spark, tmp_path):
    path = put(tmp_path, "q.csv", 'id,v\n1,"say ""hi"", x"\n2,"two\nlines"\n')
    assert rows(read_csv(spark, path, multi_line=True)) == [(1, 'say "hi", x'), (2, "two\nlines")]


def test_files_with_other_headers_are_an_error(spark, tmp_path):
    (tmp_path / "in").mkdir()
    put(tmp_path / "in", "a.csv", "id,v\n1,x\n")
    put(tmp_path / "in", "b.csv", "v,id\ny,2\n")
    with pytest.raises(Exception, match="header"):
        land_csv(spark, str(tmp_path / "in"), str(tmp_path / "out"))


def test_landed_columns_may_not_have_ingestion_names(spark, tmp_path):
    path = put(tmp_path, "c.csv", "id,ingest_year\n1,1999\n")
    with pytest.raises(ValueError, match="ingest_year"):
        land_csv(spark, path, str(tmp_path / "out"))


def test_landing_run_makes_a_folder_per_table(spark, tmp_path):
    from stratalake.plans.literacy import run_landing

    put(tmp_path / "in", "meta_brasil.csv", "ano,rede\n2024,2\n2025,3\n")
    put(tmp_path / "in", "uf.csv", "ano,sigla_uf\n2024,RO\n")
    out = tmp_path / "out"
    assert run_landing(spark, str(tmp_path / "in"), str(out), [tables.META_BRASIL, tables.UF]) == {"meta_brasil": 2, "uf": 1}
    assert rows(read_parquet(spark, str(out / "meta_brasil")), "ano", "rede") == [(2024, 2), (2025, 3)]


def test_unreadable_values_keep_their_line(spark, tmp_path):
    path = put(tmp_path, "u.csv", "a;b\n1;x\nbad;y\n;z\n")
    df = read_csv(spark, path, ";", spark.createDataFrame([], "a int, b string").schema, unreadable="_unreadable")
    assert rows(df) == [(None, "y", "bad;y"), (None, "z", None), (1, "x", None)]


def test_bronze_counts_unreadable_rows_and_silver_leaves_the_column(spark, tmp_path):
    from stratalake.plans import literacy

    names = tables.TS_ALUNO.schema.fieldNames()
    line = lambda **values: ";".join(values.get(n, "") for n in names) + "\n"
    put(tmp_path / "in", tables.TS_ALUNO.file_name, ";".join(names) + "\n" + line(ID_ALUNO="7") + line(ID_ALUNO="seven"))
    layers = literacy.Layers(*(str(tmp_path / name) for name in ("bronze", "silver", "gold")))
    assert literacy.run_bronze(spark, str(tmp_path / "in"), layers, [tables.TS_ALUNO]) == {"ts_aluno": 2, "ts_aluno._unreadable": 1}
    kept = read_parquet(spark, f"{layers.bronze}/ts_aluno").where("_unreadable is not null")
    assert rows(kept, "_unreadable") == [(line(ID_ALUNO="seven").strip(),)]
    literacy.run_silver(spark, layers, [tables.TS_ALUNO])
    assert "_unreadable" not in read_parquet(spark, f"{layers.silver}/ts_aluno").columns
