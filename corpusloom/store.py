"""Tables that are read more than once, written to the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """What ``spark.checkpoint.dir`` names. Without it a local session takes a folder of its own; a cluster has to name one."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    kept = spark.conf.get("corpusloom.shared.dir", None)
    if kept is None:
        kept = "file://" + tempfile.mkdtemp(prefix="spark-corpusloom-")
        spark.conf.set("corpusloom.shared.dir", kept)
    return kept


def run_folder(spark: SparkSession) -> str:
    """The folder of this application's tables in the shared one."""
    return f"{shared_folder(spark)}/corpusloom/{spark.sparkContext.applicationId}"


def release(spark: SparkSession) -> None:
    """Delete the tables of this application; results that read them can't be computed afterwards."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table of its own: computed once, kept when executors are lost, until :func:`release`."""
    path = f"{run_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
