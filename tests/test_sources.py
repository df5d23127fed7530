import pytest
from pyspark.sql import functions as F

from pulsetrail import session
from pulsetrail.functions.vectors import to_vector
from pulsetrail.sources import artefacts, formats, tables


def test_other_partitions_stay(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    both = spark.createDataFrame([(1, "2024-01-01"), (2, "20240102")], "v int, dt string")
    tables.write_partitions(both, path, ["dt"])
    tables.write_partition(spark.createDataFrame([(9,)], "v int"), path, dt="2024-01-01")
    assert rows(tables.scan_range(spark, path, "0", "9")) == [(2, "20240102"), (9, "2024-01-01")]
    # the compact day stays a string
    assert rows(tables.scan_day(spark, path, "20240102")) == [(2, "20240102")]


def test_catalog_tables_by_name(spark, rows, tmp_path):
    spark.sql(f"create table days (v int, dt string) using parquet partitioned by (dt) location '{tmp_path}/days'")
    tables.write_partition(spark.createDataFrame([(1,)], "v int"), "days", dt="2024-01-01")
    tables.write_partition(spark.createDataFrame([(2,)], "v int"), "days", dt="2024-01-02")
    tables.write_partition(spark.createDataFrame([(3,)], "v int"), "days", dt="2024-01-01")
    assert rows(tables.scan_range(spark, "days", "2024-01-01", "2024-12-31")) == [
        (2, "2024-01-02"),
        (3, "2024-01-01"),
    ]
    spark.sql("drop table days")


def test_writing_a_day_twice_gives_it_once(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(10)
    for _ in range(2):
        tables.write_partition(df, path, dt="2024-01-01", dtype="1")
    assert tables.scan_day(spark, path, "2024-01-01").count() == 10


def test_day_filter_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    # a table that others wrote has no descriptor
    spark.createDataFrame([(1, "a"), (2, "b")], "v int, dt string").write.partitionBy("dt").parquet(path)
    plan = tables.scan_days(spark, path, "20240130", (0, -6)).select("v")._jdf.queryExecution().toString()
    assert "PartitionFilters: [dt#" in plan and "ReadSchema: struct<v:int>" in plan


def test_libsvm_round_trip(spark, rows, tmp_path):
    path = str(tmp_path / "s")
    df = spark.sql("select 1 as label, array(0.0D, 2.5D, 0.0D) as a").select("label", to_vector("a").alias("features"))
    formats.write_libsvm(df, path)
    assert spark.read.text(path).first()[0] == "1 2:2.5"
    back = formats.read_libsvm(spark, path, 3).first()
    assert back["label"] == 1.0 and list(back["features"].toArray()) == [0.0, 2.5, 0.0]


def test_vectors_as_text(spark, tmp_path):
    path = str(tmp_path / "v")
    df = spark.sql("select 'w' as word, array(0.5D, -1.0D) as a").select("word", to_vector("a").alias("vector"))
    formats.write_vectors(df, path)
    assert spark.read.text(path).first()[0] == "w\t0.5,-1.0"
    assert list(formats.read_vectors(spark, path).first()["vector"].toArray()) == [0.5, -1.0]


def test_artefact_days():
    assert artefacts.artefact_path("/m/", "p", "20240317", lag=46) == "/m/p_2024-01-31"


def test_staging_is_a_written_table_below_the_shared_folder(spark):
    staged = session.stage(spark.range(5).withColumn("part", F.spark_partition_id()), "numbers")
    files = staged.inputFiles()
    shared = session.shared_dir(spark).removeprefix("file:")
    assert files and all(shared in f and "/numbers-" in f for f in files)
    session.discard(staged)
    with pytest.raises(Exception, match="(?i)path|file|exist"):
        spark.read.parquet(files[0].rsplit("/", 1)[0]).count()


def test_discard_leaves_other_tables_alone(spark, tmp_path):
    path = str(tmp_path / "kept")
    spark.range(3).write.parquet(path)
    session.discard(spark.read.parquet(path))
    assert spark.read.parquet(path).count() == 3


def test_clearing_ends_all_staged_tables(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    first, second = (session.stage(spark.range(n), "numbers") for n in (1, 2))
    session.clear_staged(spark)
    for df in (first, second):
        with pytest.raises(Exception, match="(?i)path|file|exist"):
            df.collect()
    assert list(tmp_path.iterdir()) == []


def test_a_cluster_needs_the_setting(monkeypatch):
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
    Session.conf = {"spark.checkpoint.dir": "hdfs://shared/"}
    assert session.shared_dir(Session()) == "hdfs://shared"


@pytest.mark.parametrize("by", [{"dt": "2024-01-02"}, {"dt": "2024-01-02", "dtype": "1"}])
@pytest.mark.parametrize("catalog", [False, True])
def test_overwrite_without_rows_empties_the_partition(spark, rows, tmp_path, by, catalog):
    name = f"emptied_{len(by)}" if catalog else f"{tmp_path}/t"
    data = spark.createDataFrame(
        [(1, "2024-01-01", "1"), (2, "2024-01-02", "1"), (3, "2024-01-02", "1")], "v int, dt string, dtype string"
    )
    data = data.select("v", *by)
    tables.write_partitions(data, name, list(by))
    tables.write_partition(data.where("false").select("v"), name, **by)
    assert rows(tables.scan_all(spark, name).select("v")) == [(1,)]
    tables.write_partition(spark.createDataFrame([(7,)], "v int"), name, **by)
    assert rows(tables.scan_all(spark, name).select("v", "dt")) == [(1, "2024-01-01"), (7, "2024-01-02")]
    if catalog:
        spark.sql(f"drop table {name}")


def test_days_by_folder_need_no_footer(spark, rows, tmp_path):
    data = spark.createDataFrame([(d, f"2024-01-0{d}") for d in range(1, 6)], "v int, dt string")
    tables.write_partitions(data, f"{tmp_path}/t", ["dt"])
    schema = "v int, dt string"
    assert rows(tables.scan_day(spark, f"{tmp_path}/t", "2024-01-03", schema)) == [(3, "2024-01-03")]
    assert len(rows(tables.scan_range(spark, f"{tmp_path}/t", "2024-01-02", "2024-01-04", schema))) == 3
    assert len(rows(tables.scan_days(spark, f"{tmp_path}/t", "20240105", [0, -1, -9], schema))) == 2
    assert rows(tables.scan_day(spark, f"{tmp_path}/t", "2023-01-01", schema)) == []


def test_a_job_leaves_nothing_staged_and_touches_nothing_else(spark):
    import os

    kept = session.stage(spark.range(3), "kept")
    with session.staged(spark):
        inside = session.stage(spark.range(5), "inside")
        files = [f.removeprefix("file://") for f in inside.inputFiles()]
        assert files and all(os.path.exists(f) for f in files)
    assert not any(os.path.exists(f) for f in files)
    assert kept.count() == 3


def test_only_the_wanted_days_are_listed(spark, tmp_path):
    """Of 200 days, a scan lists the folders it asks for; a file that is no parquet elsewhere is not met."""
    path = str(tmp_path / "daily")
    days = spark.range(200).selectExpr("id", "date_format(date_add(date'2024-01-01', int(id)), 'yyyy-MM-dd') as dt")
    tables.write_partitions(days, path, ["dt"])
    (tmp_path / "daily" / "dt=2024-01-01" / "broken.parquet").write_text("no parquet")
    assert tables.described(spark, path).names == ["id", "dt"]
    scans = {
        1: tables.scan_day(spark, path, "2024-02-01"),
        3: tables.scan_days(spark, path, "20240301", (0, -7, -14)),
        5: tables.scan_range(spark, path, "2024-03-01", "2024-03-05"),
        0: tables.scan_day(spark, path, "1999-01-01"),
        2: tables.scan_range(spark, path, "2024-02-29", "2024-03-01"),
    }
    for n, df in scans.items():
        assert df.count() == n
        assert dict(df.dtypes) == {"id": "bigint", "dt": "string"}
        if n:
            listed = df._jdf.queryExecution().analyzed().collectLeaves().head().relation().location().rootPaths()
            assert listed.size() == n


def test_descriptor_follows_the_table(spark, tmp_path):
    path = str(tmp_path / "grows")
    tables.write_partition(spark.sql("select 1 as a"), path, dt="2024-01-01")
    tables.write_partition(spark.sql("select 2 as a, 'x' as b"), path, dt="2024-01-02")
    assert tables.scan_days(spark, path, "20240102", (0, -1)).columns == ["a", "b", "dt"]
    assert tables.scan_day(spark, path, "2024-01-01").first().asDict() == {"a": 1, "b": None, "dt": "2024-01-01"}
    with pytest.raises(ValueError, match="column a of .* is int, not string"):
        tables.write_partition(spark.sql("select 'q' as a"), path, dt="2024-01-02")
    assert tables.scan_day(spark, path, "2024-01-02").first()["a"] == 2
    other = str(tmp_path / "foreign")
    spark.sql("select 5 as a, '20240101' as dt").write.partitionBy("dt").parquet(other)
    assert tables.described(spark, other) is None
    assert tables.scan_day(spark, other, "20240101").first()["a"] == 5
    tables.describe(spark, other)
    assert tables.described(spark, other).simpleString() == "struct<a:int,dt:string>"
    assert tables.scan_day(spark, other, "20240101").first()["a"] == 5


def test_ranges_of_days():
    assert tables._range("20240228", "20240301") == ["20240228", "20240229", "20240301"]
    assert tables._range("2024-02-29", "2024-02-29") == ["2024-02-29"]
    for first, last in [("0", "9"), ("2024-03-01", "2024-02-01"), ("2024-01-01", "20240102"), ("20240101", "x")]:
        assert tables._range(first, last) is None
