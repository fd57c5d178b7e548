"""Versioned datasets: one ``version=yyyy_MM`` partition per run month."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidegrid.functions.periods import version_of
from tidegrid.sources.readers import missing_as_null

VERSION = "version"


class NoVersionError(FileNotFoundError):
    """A versioned dataset has no version yet."""


def version_label(run_date: date) -> str:
    return run_date.strftime("%Y_%m")


def stamp_version(df: DataFrame, run_date: date | str) -> DataFrame:
    """Add the version of a run. ``run_date`` is a date, or the name of a date column."""
    at = F.col(run_date) if isinstance(run_date, str) else F.lit(run_date)
    return df.withColumn(VERSION, version_of(at))


def list_versions(df: DataFrame, column: str = VERSION) -> DataFrame:
    """Distinct versions in name order."""
    return df.select(column).distinct().orderBy(column)


def list_files(spark: SparkSession, folder: str, prefix: str, suffix: str = ".csv") -> DataFrame:
    """Names of the files in a folder by prefix and suffix, sorted. Reads no file content."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", f"{prefix}*{suffix}").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    return listing.select(name.alias("file_name")).orderBy("file_name")


def latest_version(df: DataFrame, column: str = VERSION) -> DataFrame:
    """Rows of the greatest version. On a partitioned table the scalar subquery prunes the scan to
    one partition."""
    newest = df.agg(F.max(column)).scalar()
    return df.where(F.col(column) == newest)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def read_versions(spark: SparkSession, path: str, schema: StructType, fmt: str = "csv") -> DataFrame:
    """All versions of a dataset, or :class:`NoVersionError` when nothing was written yet."""
    if not path_exists(spark, path):
        raise NoVersionError(f"no versions under {path}")
    full = StructType(schema.fields).add(VERSION, "string")
    reader = spark.read.schema(full)
    if fmt == "csv":
        reader = reader.option("header", True).option("mode", "FAILFAST")
    return missing_as_null(reader.format(fmt).load(path))


def has_version(spark: SparkSession, path: str, version: str) -> bool:
    return path_exists(spark, f"{path}/{VERSION}={version}")


def version_folders(spark: SparkSession, path: str) -> list[str]:
    """Versions of a stored dataset by the names of its partition folders; opens no data file."""
    if not path_exists(spark, path):
        return []
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [f.getPath().getName() for f in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
             if f.isDirectory()]
    return sorted(n.removeprefix(f"{VERSION}=") for n in names if n.startswith(f"{VERSION}="))


def read_latest(spark: SparkSession, path: str, schema: StructType, fmt: str = "csv") -> DataFrame:
    """Rows of the latest version of a stored dataset, from its one partition; raises when there is none."""
    folders = version_folders(spark, path)
    if not folders:
        raise NoVersionError(f"no versions under {path}")
    return read_versions(spark, path, schema, fmt).where(F.col(VERSION) == folders[-1])
