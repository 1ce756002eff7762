"""Results that several jobs read, kept in the folder every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[str] = []
_local: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a scratch one only for a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if not _local:
        _local.append(tempfile.mkdtemp(prefix="quern-"))
    return _local[0]


def new_path(spark: SparkSession) -> str:
    """A path of its own in the shared folder, deleted by ``release``."""
    path = f"{shared_folder(spark).rstrip('/')}/quern-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` once and read it back, so that later jobs see exactly these rows.

    Used where a second job must agree with a first one on where each row lies.
    """
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of a small state that a loop refines."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def discard(frame: DataFrame) -> None:
    """Delete the files of a frame that ``staged`` returned, once nothing will read it again."""
    spark = frame.sparkSession
    for folder in {path.rsplit("/", 1)[0] for path in frame.inputFiles()}:
        known = [path for path in _written if folder.endswith(path.rsplit("/", 1)[-1])]
        for path in known:
            _delete(spark, path)
            _written.remove(path)


def _delete(spark: SparkSession, name: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Delete what this process wrote to the shared folder; frames that read it are then invalid."""
    while _written:
        _delete(spark, _written.pop())
