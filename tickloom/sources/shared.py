"""Written tables in the cluster's shared folder.

A result that several branches of a plan need is written once and read back:
the lineage is cut, a lost executor costs nothing, and the optimizer sees the
table's real size, so it broadcasts it only when it is small.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Rows of a task that groups them when nearly every row may be a group of its own.
TASK_ROWS = 1 << 20


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tickloom-"))
    return spark.sparkContext.getCheckpointDir()


def _own_folder(spark: SparkSession) -> str:
    """The application's own part of the shared folder, so that all it wrote can go at once."""
    return f"{shared_folder(spark)}/tickloom-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _located(spark: SparkSession, path: str) -> tuple:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _located(spark, path)
    return files.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, those of unfinished things aside; none if there is no folder."""
    files, target = _located(spark, path)
    if not files.exists(target):
        return []
    return sorted(n for s in files.listStatus(target) if (n := s.getPath().getName())[0] not in "._")


def moved(spark: SparkSession, path: str, to: str) -> bool:
    """Rename a complete folder; False if the new name is taken."""
    files, source = _located(spark, path)
    _, target = _located(spark, to)
    files.mkdirs(target.getParent())
    return not files.exists(target) and files.rename(source, target)


def discard(spark: SparkSession, path: str | None = None) -> None:
    """Delete one written table, or all that this application wrote; frames on them cannot be read again."""
    files, target = _located(spark, path or _own_folder(spark))
    files.delete(target, True)


def in_small_tasks(df: DataFrame, n_rows: int, *columns: str) -> DataFrame:
    """``df`` dealt by the hash of ``columns`` to tasks of about ``TASK_ROWS`` rows, as it is if one task holds them.

    A scan's task may read any number of rows, and an aggregate that meets a new group in most of them holds them all.
    """
    parts = -(-n_rows // TASK_ROWS)
    return df.repartition(parts, *columns) if parts > 1 else df


def written_once(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
