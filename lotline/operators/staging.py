"""Intermediate tables that several parts of a plan read: written once to the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Local sessions get a temporary folder where none is named; a cluster must name one."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = tempfile.mkdtemp(prefix="lotline-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def settled(df: DataFrame, name: str) -> DataFrame:
    """df as a written table: it is worked out once, and what reads it survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/lotline-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
