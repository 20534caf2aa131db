"""Where jobs put tables they write for themselves."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


class NoSharedFolder(RuntimeError):
    """The cluster names no folder that all its machines see."""


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``. Where it is unset, a
    single-process session (``local[...]``, as in tests) gets a new local folder; a cluster
    does not, since each of its machines would see only its own files there."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise NoSharedFolder(f"set spark.checkpoint.dir to a folder that all machines of {master or 'the cluster'} share")
        folder = tempfile.mkdtemp(prefix="kerbside-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never one that was used before."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# Spark drops what a query has exchanged when the query ends, not when the driver's memory is
# next cleared, which may be never in a long job. (Releases that lack the setting ignore it.)
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a fresh path and read back: its lineage ends there, so a lost
    executor costs the reading of a few files and not the work behind them, and the files
    exchanged for it leave the executors' disks."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    files, hadoop_path = _file_system(spark, path)
    return files.exists(hadoop_path)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    files, hadoop_path = _file_system(spark, path)
    return [s.getPath().getName() for s in files.listStatus(hadoop_path)] if files.exists(hadoop_path) else []


# A folder counts as finished only with this mark. Spark's own success file depends on
# settings: a dynamic partition overwrite, for one, leaves none.
_MARK = "_FINISHED"


def mark_finished(spark: SparkSession, path: str) -> None:
    files, mark = _file_system(spark, f"{path}/{_MARK}")
    files.create(mark, True).close()


def is_finished(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/{_MARK}")
