"""Tables that cut lineage, kept in the shared folder of the cluster."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_MADE: dict[str, list[str]] = {}


#: Read where ``spark.checkpoint.dir``, which a running session cannot change, is not set.
OWN_SETTING = "spark.shelfcast.folder"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; without a setting there is nowhere to write."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(OWN_SETTING, None)
    if not folder:
        raise ValueError("Set spark.checkpoint.dir to a folder that the driver and every executor can reach.")
    return folder.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    path = f"{shared_folder(spark)}/shelfcast/{label}-{uuid.uuid4().hex}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as parquet and read it back.

    Later steps start from the file, so lost executors cost only the tasks they were running, and
    column pruning and filters still reach the scan.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(target, True)


def replace(old: DataFrame, new: DataFrame, label: str) -> DataFrame:
    """Write ``new``, which is made from the written table ``old``, and delete ``old``."""
    spark = new.sparkSession
    superseded = {path.rpartition("/")[0] for path in old.inputFiles()}
    made = _MADE.get(spark.sparkContext.applicationId, [])
    written = materialize(new, label)
    for path in [p for p in made if any(s.endswith(p.removeprefix("file://")) for s in superseded)]:
        _delete(spark, path)
        made.remove(path)
    return written


def release(spark: SparkSession) -> None:
    """Delete every folder that this application has made; call it when no table of it is needed."""
    for path in _MADE.pop(spark.sparkContext.applicationId, []):
        _delete(spark, path)
