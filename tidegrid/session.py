"""Session settings and lineage cuts shared by all jobs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "tidegrid", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session; ``conf`` keys use ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, val in {**SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, val)
    return builder.getOrCreate()


#: Folders under the checkpoint folder that this process has asked for and not released.
_scratch: list[str] = []


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A new path in the folder that all executors share; only a local-mode session without one gets its own."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidegrid-"))
        folder = context.getCheckpointDir()
    _scratch.append(f"{folder}/{kind}-{uuid.uuid4().hex}")
    return _scratch[-1]


def release(spark: SparkSession) -> None:
    """Delete what this process has put under :func:`scratch_path`; call it when no frame built on it is needed."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while _scratch:
        path = jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        path.getFileSystem(conf).delete(path, True)


def discard(df: DataFrame) -> None:
    """Delete the files of one frame of :func:`stored` before the rest, in loops that need no more than their last round."""
    spark = df.sparkSession
    folders = {f.rpartition("/")[0] for f in df.inputFiles()}
    for path in [p for p in _scratch if any(f.endswith(p.rpartition("/")[2]) for f in folders)]:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        _scratch.remove(path)


def stored(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the cluster's checkpoint folder and read it back.

    Cuts the lineage before loops of passes and fits: losing an executor then re-reads files instead
    of recomputing the feature pipeline, and every pass sees the same rows. Unlike an RDD
    checkpoint, the columnar files let each pass read only its columns. With ``by``, equal values of those columns have a
    folder, and a pass that wants few values opens no others.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "stored")
    df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
