import json
from datetime import date

import pytest

from ledgerloom.session import new_shared_path, shared_root
from ledgerloom.sources import files, sql, tables

SCHEMA = "id long, value double, name string"


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(1, 1.5, "a"), (2, float("nan"), None), (3, None, "c")], SCHEMA)


def content(df):
    return sorted(map(tuple, df.collect()))


CLEAN = [(1, 1.5, "a"), (2, None, None), (3, None, "c")]


def test_loaders_turn_nan_into_null(spark, rows, tmp_path):
    csv, parquet = str(tmp_path / "t.csv"), str(tmp_path / "t.parquet")
    rows.write.option("header", True).csv(csv)
    rows.write.parquet(parquet)
    assert content(files.load_table(spark, csv, SCHEMA)) == CLEAN
    assert content(files.load_table(spark, parquet)) == CLEAN
    assert content(files.load_object_store(spark, parquet)) == CLEAN
    assert dict(files.load_csv(spark, csv).dtypes)["id"] == "int"


@pytest.mark.parametrize("path", ["data.json", "data", "data.parquet.gz"])
def test_other_suffixes_are_refused(spark, path):
    with pytest.raises(ValueError, match="unsupported"):
        files.load_table(spark, path)


def test_missing_file_raises(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)path"):
        files.load_table(spark, str(tmp_path / "absent.parquet"))


def test_object_store_scheme():
    assert files.object_store_path("s3://bucket/dir/") == "s3a://bucket/dir/"
    assert files.object_store_path("/local/dir") == "/local/dir"


def test_records(spark, tmp_path):
    path = tmp_path / "r.json"
    records = [{"customer_id": 1, "amount": 2.5, "extra": True}, {"customer_id": 2}]
    path.write_text("\n".join(map(json.dumps, records)))
    schema = "customer_id long, amount double, merchant_category string"
    assert content(files.records_to_frame(spark, str(path), schema)) == [(1, 2.5, None), (2, None, None)]
    with pytest.raises(Exception, match="unknown keys: extra"):
        files.records_to_frame(spark, str(path), schema, "fail").collect()
    path.write_text(json.dumps(records[1]))
    assert content(files.records_to_frame(spark, str(path), schema, "fail")) == [(2, None, None)]
    with pytest.raises(ValueError):
        files.records_to_frame(spark, str(path), schema, "guess")


def test_extract_sql(spark, rows):
    rows.createOrReplaceTempView("extract_rows")
    found = sql.extract_sql(spark, "SELECT id FROM extract_rows WHERE id >= :low", args={"low": 2})
    assert content(found) == [(2,), (3,)]
    spark.sql("CREATE DATABASE IF NOT EXISTS side")
    rows.select("id").write.mode("overwrite").saveAsTable("side.only_there")
    assert content(sql.extract_sql(spark, "SELECT * FROM only_there", schema="side")) == [(1,), (2,), (3,)]
    with pytest.raises(Exception, match="only_there"):
        sql.extract_sql(spark, "SELECT * FROM only_there")
    assert spark.catalog.currentDatabase() == "default"


def test_extract_from_several_sources(spark, rows):
    rows.createOrReplaceTempView("multi_rows")
    texts = {"spark_catalog.default": "SELECT id FROM multi_rows", "spark_catalog": "SELECT max(id) AS m FROM multi_rows"}
    found = sql.extract_sql_multi(spark, texts)
    assert list(found) == list(texts) and found["spark_catalog.default"].count() == 3
    with pytest.raises(Exception, match="nowhere"):
        sql.extract_sql_multi(spark, {"spark_catalog": "SELECT 1 AS one", "spark_catalog.default": "SELECT * FROM nowhere"})
    with pytest.raises(Exception):
        sql.extract_sql_multi(spark, {"no_such_catalog.x": "SELECT 1 AS one"})
    assert spark.catalog.currentCatalog() == "spark_catalog"


@pytest.mark.parametrize("source, parts", [("hive.default", ("hive", "default")), ("postgres.public", ("postgres", "public")), ("hive", ("hive", "default"))])
def test_source_names(source, parts):
    assert sql.split_source(source) == parts


def test_jdbc_options():
    plain = sql.jdbc_options("jdbc:x", query="SELECT 1")
    assert plain["query"] == "SELECT 1" and plain["queryTimeout"] == "7200"
    split = sql.jdbc_options("jdbc:x", table="t", partition_column="id", lower=0, upper=100, partitions=8)
    assert (split["dbtable"], split["numPartitions"], split["partitionColumn"]) == ("t", "8", "id")
    both = sql.jdbc_options("jdbc:x", query="SELECT id FROM t", partition_column="id", lower=0, upper=9, partitions=2)
    assert "query" not in both and both["dbtable"].startswith("(SELECT id FROM t)")
    for wrong in ({}, {"table": "t", "query": "q"}, {"table": "t", "partition_column": "id"}):
        with pytest.raises(ValueError):
            sql.jdbc_options("jdbc:x", **wrong)


def test_catalog_settings():
    pg = sql.jdbc_catalog_conf("postgresql", "jdbc:postgresql://db/x")
    assert pg["spark.sql.catalog.postgresql"].endswith("JDBCTableCatalog")
    hive = sql.hive_catalog_conf("thrift://meta:9083", "http://store:9000")
    assert hive["spark.sql.catalogImplementation"] == "hive" and "spark.hadoop.fs.s3a.endpoint" in hive


def test_run_tables_replace_their_day_only(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    one, two = date(2024, 1, 1), date(2024, 1, 2)
    tables.write_run_table(rows, path, one)
    tables.write_run_table(rows.limit(1), path, two)
    back = tables.write_run_table(rows.where("id > 1"), path, two)
    assert back.columns == rows.columns and back.count() == 2
    assert tables.read_run_table(spark, path, one).count() == 3
    assert tables.read_run_table(spark, path).count() == 5


def test_run_day_prunes_partitions(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    tables.write_run_table(rows, path, date(2024, 1, 1))
    plan = tables.read_run_table(spark, path, date(2024, 1, 1))._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(run_date" in plan


def test_shared_folder_is_the_configured_one(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_shared_path(spark, "x").startswith(shared_root(spark))
    assert new_shared_path(spark, "x") != new_shared_path(spark, "x")


def test_an_empty_rerun_replaces_its_day(spark, tmp_path):
    day, path = date(2024, 3, 5), str(tmp_path / "runs")
    full = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    assert tables.write_run_table(full.where("id > 9"), path, day).columns == ["id", "name"]  # first of all no rows
    assert tables.write_run_table(full, path, day).count() == 2
    assert tables.write_run_table(full, path, date(2024, 3, 6)).count() == 2
    assert tables.write_run_table(full.where("id > 9"), path, day).count() == 0
    assert tables.read_run_table(spark, path, day).count() == 0
    assert tables.read_run_table(spark, path).count() == 2


@pytest.mark.parametrize("keys", ["drop", "fail"])
@pytest.mark.parametrize("line", ['{"id": 2, "amount": "abc"}', "not json", '{"id": 3, "amou'])
def test_malformed_records_raise(spark, tmp_path, keys, line):
    (tmp_path / "records.json").write_text('{"id": 1, "amount": 2.5}\n' + line + "\n")
    with pytest.raises(Exception, match="(?i)malformed|failfast"):
        files.records_to_frame(spark, str(tmp_path / "records.json"), "id int, amount double", keys).collect()
