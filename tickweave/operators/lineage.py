"""Rows that are read many times, kept where they have been worked out once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def kept(df: DataFrame, name: str) -> DataFrame:
    """The same rows as a Parquet table in ``spark.checkpoint.dir``, under one folder for each application, which may go when that ends.

    Without that setting, which names a folder that driver and executors
    share, the rows are as they were and are worked out wherever they are read.
    """
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        return df
    path = f"{folder}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
