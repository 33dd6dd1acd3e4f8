"""Tables that work leaves on its way, in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession) -> str:
    """A new folder in the shared one, which a cluster names in spark.checkpoint.dir. A session in one
    process may do without and gets one in its warehouse."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where is None:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        where = spark.conf.get("spark.sql.warehouse.dir")
    return f"{where.rstrip('/')}/scratch-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """`df` written and read again: it is computed once, whatever reads it, and later work survives
    lost executors."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
