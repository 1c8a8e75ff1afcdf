"""Reading and writing tables, views, and the options of database reads."""

import pytest
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from tallybrook.operators.joins import equi_join
from tallybrook.session import work_folder
from tallybrook.sources import catalog, files
from tallybrook.sources.jdbc import Ranges, jdbc_options
from tallybrook.streaming.topics import as_messages

PERSON = T.StructType([T.StructField("name", T.StringType()), T.StructField("age", T.IntegerType())])


@pytest.fixture
def people(tmp_path):
    (tmp_path / "people.csv").write_text("name,age\nalice,18\nbob,14")
    return str(tmp_path / "people.csv")


@pytest.fixture
def dirty(tmp_path):
    (tmp_path / "dirty.csv").write_text("name,age\nalice,18\nbob,xx\ncarol,7,zz\n")
    return str(tmp_path / "dirty.csv")


def test_csv_with_and_without_schema(spark, people, rows):
    assert rows(files.read_csv(spark, people)) == [("alice", "18"), ("bob", "14")]
    assert rows(files.read_csv(spark, people, PERSON)) == [("alice", 18), ("bob", 14)]


def test_dirty_records(spark, dirty, rows):
    assert rows(files.read_csv(spark, dirty, PERSON)) == [("alice", 18), ("bob", None), ("carol", 7)]
    assert rows(files.read_csv(spark, dirty, PERSON, "dropMalformed")) == [("alice", 18)]
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        files.read_csv(spark, dirty, PERSON, "failFast").collect()


def test_dirty_records_do_not_depend_on_the_columns_used(spark, dirty, rows):
    kept = files.read_csv(spark, dirty, PERSON, "dropmalformed")
    assert kept.count() == 1 and rows(kept.select("name")) == [("alice",)]
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        files.read_csv(spark, dirty, PERSON, "failfast").select("name").collect()


def test_quarantine(spark, dirty, rows):
    table = files.read_csv(spark, dirty, PERSON, quarantine=True)
    bad = table.where(f"{files.CORRUPT} is not null")
    assert rows(bad.select("name", files.CORRUPT)) == [("bob", "bob,xx"), ("carol", "carol,7,zz")]


def test_csv_options(spark, tmp_path, rows):
    (tmp_path / "o.csv").write_text('n|d|s\n1|03.02.2024|"a\\"|b"\nNA|NA|NA\n')
    schema = T.StructType().add("n", "integer").add("d", "date").add("s", "string")
    table = files.read_csv(spark, str(tmp_path / "o.csv"), schema, sep="|", escape="\\", nullValue="NA", dateFormat="dd.MM.yyyy")
    assert [(r["n"], str(r["d"]), r["s"]) for r in table.collect()] == [(1, "2024-02-03", 'a"|b'), (None, "None", None)]


@pytest.mark.parametrize("form", ["parquet", "orc", "json"])
def test_round_trips(spark, tmp_path, rows, form):
    df = spark.createDataFrame([("bob", 14), ("é", None)], PERSON)
    files.write_table(df, str(tmp_path / form), format=form)
    assert rows(files.read_table(spark, str(tmp_path / form), form, PERSON)) == rows(df)


def test_write_modes(spark, tmp_path):
    df, path = spark.range(3), str(tmp_path / "t")
    count = lambda: spark.read.parquet(path).count()
    files.write_table(df, path)
    with pytest.raises(AnalysisException):
        files.write_table(df, path)
    files.write_table(df, path, "ignore")
    assert count() == 3
    files.write_table(df, path, "append")
    assert count() == 6
    files.write_table(df, path, "overwrite")
    assert count() == 3


def test_partition_folders(spark, tmp_path, plan, rows):
    df = spark.createDataFrame([("c1", 201512), ("c2", 201601), ("c3", 201706)], "carNum string, batchNum int")
    files.write_table(df, str(tmp_path / "t"), partition_by=["batchNum"])
    recent = files.read_table(spark, str(tmp_path / "t")).where("batchNum >= '201601'")
    assert rows(recent.select("carNum")) == [("c2",), ("c3",)]
    assert "PartitionFilters: [isnotnull(batchNum" in plan(recent)
    part = str(next((tmp_path / "t" / "batchNum=201706").glob("*.parquet")))
    assert files.read_part(spark, part).columns == ["carNum"]
    assert rows(files.read_part(spark, part, str(tmp_path / "t"))) == [("c3", 201706)]


def test_filters_and_columns_reach_the_scan(spark, tmp_path, plan):
    spark.range(10).selectExpr("id as a", "id as b", "id as c").write.parquet(str(tmp_path / "t"))
    text = plan(files.read_table(spark, str(tmp_path / "t")).where("a > 3").select("b"))
    assert "GreaterThan(a,3)" in text and "ReadSchema: struct<a:bigint,b:bigint>" in text


def test_lines_are_dealt_out_when_asked_for(spark, tmp_path, plan):
    import gzip

    with gzip.open(tmp_path / "a.gz", "wt") as out:
        out.writelines(f"line {i}\n" for i in range(9000))
    lines = files.read_lines(spark, str(tmp_path / "a.gz"), min_partitions=4)
    assert sorted(r["count"] for r in lines.groupBy(F.spark_partition_id()).count().collect()) == [2250] * 4
    assert "RoundRobin" not in plan(files.read_lines(spark, str(tmp_path / "a.gz")))


def test_min_partitions_is_a_least_number(spark, plan, tmp_path):
    """A large file is read in as many parts as it has, not in the few that were asked for."""
    (tmp_path / "long.txt").write_text("".join(f"line {i}\n" for i in range(4000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = files.read_lines(spark, str(tmp_path / "long.txt"), min_partitions=4, line_end="\n")
        assert lines.rdd.getNumPartitions() > 4 and "RoundRobin" not in plan(lines)
        assert sorted(r[0] for r in lines.collect()) == sorted(f"line {i}" for i in range(4000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_views_and_catalog(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, 410), (2, 95)], "id int, salary int")
    assert rows(catalog.select_all(spark, catalog.session_view(df, "t1"))) == rows(df)
    shared = catalog.shared_view(df, "t2")
    assert spark.newSession().sql(f"select * from {shared}").count() == 2
    catalog.save_catalog_table(df, "salaries", str(tmp_path / "salaries"))
    assert rows(catalog.select_all(spark, "salaries")) == rows(catalog.catalog_table(spark, "salaries")) == rows(df)
    spark.sql("drop table salaries")


def test_work_folder_is_below_the_shared_one(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    one, two = work_folder(spark, "x"), work_folder(spark, "x")
    assert one.startswith(root + "/") and one != two


URL = {"url": "jdbc:some:db", "driver": "some.Driver"}


def test_database_table_options():
    plain = jdbc_options(**URL, table="people", user="u", password="p", fetchsize="1000")
    assert plain == {**URL, "dbtable": "people", "user": "u", "password": "p", "fetchsize": "1000"}
    cut = jdbc_options(**URL, table="people", ranges=Ranges("id", 1, 1000, 20))
    assert cut["partitionColumn"] == "id" and cut["numPartitions"] == "20"
    assert (cut["lowerBound"], cut["upperBound"]) == ("1", "1000")


def test_database_query_options():
    assert jdbc_options(**URL, query="select 1")["query"] == "select 1"
    cut = jdbc_options(**URL, query="select * from people", ranges=Ranges("id", 1, 9, 2))
    assert cut["dbtable"] == "(select * from people) cut_query" and "query" not in cut


def test_database_options_that_would_not_work():
    with pytest.raises(ValueError, match="table or a query"):
        jdbc_options(**URL)
    with pytest.raises(ValueError, match="does not split"):
        jdbc_options(**URL, table="people", numPartitions="20")


def test_topic_messages(spark, rows):
    df = spark.createDataFrame([("a", 1.5)], "k string, v double")
    assert rows(as_messages(df, "k", "v")) == [("a", "1.5")]


def test_tables_stored_by_key_are_joined_and_grouped_without_a_shuffle(spark, tmp_path, rows, plan):
    left = spark.range(2000).selectExpr("id % 300 as k", "id as a")
    right = spark.range(250).selectExpr("id as k", "id * 2 as b")
    for name, table in (("by_key_l", left), ("by_key_r", right)):
        catalog.save_by_key(table, name, str(tmp_path / name), ["k"], 6)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        both = equi_join(catalog.catalog_table(spark, "by_key_l"), catalog.catalog_table(spark, "by_key_r"), "k")
        sums = both.groupBy("k").count()
        plain = equi_join(left, right, "k")
        assert "Exchange" not in plan(sums) and "SortMergeJoin" in plan(sums) and "Exchange" in plan(plain)
        assert rows(both) == rows(plain)
        assert len(list((tmp_path / "by_key_l").glob("part-*.parquet"))) == 6
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("by_key_l", "by_key_r"):
            spark.sql(f"drop table {name}")
