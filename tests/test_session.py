from types import SimpleNamespace

import pytest

from parcelstar.session import scratch_path, shared_folder, write_through


def conf_of(**settings):
    names = {k.replace("__", "."): v for k, v in settings.items()}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: names.get(k, d)))


def test_configured_folder_is_used(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    assert scratch_path(spark, "x").startswith(f"{folder}/parcelstar/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_cluster_without_the_setting_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(conf_of(spark__master="yarn"))
    cluster = conf_of(spark__master="yarn", spark__checkpoint__dir="hdfs:///shared/")
    assert shared_folder(cluster) == "hdfs:///shared"


def test_local_session_gets_one_folder():
    local = conf_of(spark__master="local[2]", spark__app__id="some-app")
    assert shared_folder(local) == shared_folder(local)


def test_write_through_keeps_rows_and_schema(spark):
    df = spark.range(10).selectExpr("id", "cast(null AS string) AS t")
    written = write_through(df, "rows")
    assert written.schema.names == df.schema.names and written.count() == 10
    assert "FileScan parquet" in written._jdf.queryExecution().toString()
    assert write_through(df.where("id < 0"), "none").count() == 0
