import datetime as dt

import pytest
from pyspark.sql import functions as F

from recordloom.operators.projection import replace_columns
from recordloom.sources import (
    CRASHES,
    REQUESTS,
    database_for,
    materialize,
    read_seed,
    read_table,
    recover_path,
    scratch_dir,
    write_path,
    write_table,
)


def test_seed_stays_text_with_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_text(
        'zip_code,borough,geom_wkt\n00501,Queens,"POLYGON((0 0, 1 0,\n1 1, 0 0))"\n10001,"The ""old"" town","POLYGON((0 0, 1 0, 1 1, 0 0))"\n'
    )
    rows = read_seed(spark, str(path)).orderBy("zip_code").collect()
    assert [r.zip_code for r in rows] == ["00501", "10001"]
    assert rows[0].geom_wkt == "POLYGON((0 0, 1 0,\n1 1, 0 0))" and rows[1].borough == 'The "old" town'


def test_seed_columns_go_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("borough,zip_code,geom_wkt\nBronx,10451,x\n")
    assert read_seed(spark, str(tmp_path / "a.csv")).first().asDict() == {"zip_code": "10451", "borough": "Bronx", "geom_wkt": "x"}
    (tmp_path / "b.csv").write_text("zip_code,geom_wkt\n10451,x\n")
    with pytest.raises(ValueError, match="borough"):
        read_seed(spark, str(tmp_path / "b.csv"))
    (tmp_path / "c.csv").write_text("zip_code,borough,geom_wkt\n10451,Bronx\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_seed(spark, str(tmp_path / "c.csv")).collect()


def test_raw_schemas(spark, tmp_path):
    assert (len(REQUESTS), len(CRASHES)) == (33, 29)
    spark.createDataFrame([("007", dt.datetime(2024, 1, 1))], "unique_key string, created_date timestamp").write.parquet(str(tmp_path / "r"))
    df = read_table(spark, str(tmp_path / "r"), REQUESTS)
    assert df.columns == REQUESTS.fieldNames() and df.first().unique_key == "007" and df.first().agency is None


def test_layers():
    layers = {"a": "  shelf ", "b": None}
    assert [database_for(layer, layers, "home") for layer in "abc"] == ["shelf", "home", "home"]


def test_full_refresh(spark, tmp_path):
    first, second = spark.range(5), spark.range(3).withColumn("x", F.lit("v"))
    write_path(first.toDF("id"), str(tmp_path / "t"))
    assert write_path(second, str(tmp_path / "t"), partition_by=["x"]).count() == 3
    write_table(first, "t", "recordloom_test")
    assert write_table(second, "t", "recordloom_test").columns == ["id", "x"]
    assert spark.table("recordloom_test.t").count() == 3
    spark.sql("DROP DATABASE recordloom_test CASCADE")


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_path(spark.range(5), path)
    bad = spark.range(9).select(F.when(F.col("id") == 7, F.raise_error(F.lit("broken")).cast("bigint")).otherwise(F.col("id")).alias("id"))
    for _ in range(2):
        with pytest.raises(Exception, match="broken"):
            write_path(bad, path)
        assert spark.read.parquet(path).count() == 5
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]  # nothing stays behind
    assert write_path(spark.range(9), path).count() == 9  # and the retry publishes
    write_table(spark.range(5), "t", "recordloom_test")
    with pytest.raises(Exception, match="broken"):
        write_table(bad, "t", "recordloom_test")
    assert spark.table("recordloom_test.t").count() == 5
    assert write_table(spark.range(9), "t", "recordloom_test").count() == 9
    assert [t.name for t in spark.catalog.listTables("recordloom_test")] == ["t"]
    spark.sql("DROP DATABASE recordloom_test CASCADE")


def test_a_table_may_be_replaced_by_what_it_holds(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (5, 4):
        kept = write_path(spark.range(5) if n == 5 else spark.read.parquet(path).filter("id > 0"), path)
        assert kept.count() == n
    write_table(spark.range(5), "t", "recordloom_test")
    assert write_table(spark.table("recordloom_test.t").filter("id > 0"), "t", "recordloom_test").count() == 4
    spark.sql("DROP DATABASE recordloom_test CASCADE")


def test_a_writer_that_died_is_made_good(spark, tmp_path):
    """The old table was taken away, and the new one did not come."""
    path = str(tmp_path / "t")
    write_path(spark.range(5), path)
    (tmp_path / "t").rename(tmp_path / "_replaced-t-1-a")
    assert recover_path(spark, path) and spark.read.parquet(path).count() == 5
    assert not recover_path(spark, path)
    (tmp_path / "t").rename(tmp_path / "_replaced-t-1-a")
    kept = write_path(spark.range(3), path)
    assert kept.count() == 3 and sorted(p.name for p in tmp_path.iterdir()) == ["t"]


def test_scratch_follows_the_session(spark):
    assert scratch_dir(spark) == (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()).rstrip("/")
    df = materialize(spark.range(4), "four")
    assert df.count() == 4 and df.inputFiles()[0].removeprefix("file://").startswith(scratch_dir(spark).removeprefix("file://"))


def test_scratch_refuses_a_cluster_without_a_shared_folder():
    class Context:
        master = "yarn"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    with pytest.raises(ValueError):
        scratch_dir(Session())


def test_replace_columns_keeps_an_open_schema(spark):
    df = spark.createDataFrame([(1, "x", "extra", "y")], "a int, b string, new string, c string")
    out = replace_columns(df, ["a", "c"], {"id": F.col("a").cast("string"), "c": F.upper("c")})
    assert out.columns == ["b", "new", "id", "c"] and tuple(out.first()) == ("x", "extra", "1", "Y")
