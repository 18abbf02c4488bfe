"""Session settings and the shared folder intermediate tables are written to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


def build_session(app_name: str = "parcelstar", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        # Larger generated methods are not compiled by HotSpot; Spark then runs the
        # operators one by one, which are.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`, which every executor can reach.

    Only a local session without that setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="parcelstar-")
    return _local_folders[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_folder(spark), "parcelstar", f"{name}-{uuid.uuid4().hex}")


def write_through(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write `df` to the shared folder and continue from the written table.

    This cuts the lineage, fixes the rows for every later pass (also after an
    executor is lost) and gives Catalyst the table's real size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
