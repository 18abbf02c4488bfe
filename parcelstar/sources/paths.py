"""Folder layout of the zones."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import SparkSession

from parcelstar.constants import API_SOURCE, BULK_SOURCE


NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
#: How the drop folders of streams begin.
STREAM_DROP = "drop=stream-"


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does a file or folder exist, on any file system Spark can reach?"""
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the partition folders of a path; the files are not read."""
    fs, target = _file_system(spark, f"{path}/{column}=*")
    folders = [status.getPath().getName() for status in fs.globStatus(target) or []]
    return [unquote(name.split("=", 1)[1]) for name in folders]


def finished_folders(spark: SparkSession, path: str, column: str) -> tuple[list[str], list[str]]:
    """The partition folders of a path that a finished write left, and the others."""
    fs, target = _file_system(spark, f"{path}/{column}=*")
    done: tuple[list[str], list[str]] = ([], [])
    for status in fs.globStatus(target) or []:
        folder = status.getPath().toString()
        done[not path_exists(spark, f"{folder}/_SUCCESS")].append(folder)
    return done


def landed_paths(spark: SparkSession, path: str) -> list[str]:
    """The finished drops of a landing folder; a path without drops stands for itself."""
    done, broken = finished_folders(spark, path, "drop")
    return done if done or broken else [path]


def delete_folders(spark: SparkSession, folders: list[str]) -> None:
    for folder in folders:
        fs, target = _file_system(spark, folder)
        fs.delete(target, True)


def drop_folders(spark: SparkSession, path: str, column: str, values: set[str]) -> list[str]:
    """Delete the partition folders of these values; returns the folders that were there."""
    fs, target = _file_system(spark, f"{path}/{column}=*")
    gone = []
    for status in fs.globStatus(target) or []:
        folder = status.getPath()
        if unquote(folder.getName().split("=", 1)[1]) in values and fs.delete(folder, True):
            gone.append(folder.toString())
    return gone


def raw_bulk(raw_root: str, execution_date: str) -> str:
    return f"{raw_root}/{BULK_SOURCE}/execution_date={execution_date}"


def raw_api_listings(raw_root: str, execution_date: str) -> str:
    return f"{raw_root}/{API_SOURCE}/execution_date={execution_date}/listings-sale"


def raw_market(raw_root: str, execution_date: str) -> str:
    return f"{raw_root}/{API_SOURCE}/execution_date={execution_date}/market"


def staged(staging_root: str, source: str, execution_date: str, table: str) -> str:
    return f"{staging_root}/{source}/{execution_date}/{table}.parquet"
