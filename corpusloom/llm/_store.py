"""Tables and files in the shared folder that the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..store import shared_folder


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/corpusloom/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and return the table.

    This cuts the lineage, survives lost executors and keeps expensive scans from being repeated.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
