"""Tables that a query writes for itself: lineage is cut and every later step
reads the same rows in the same partitions."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or the one
    given to ``setCheckpointDir``.  Only a local session that names none gets a
    temporary folder."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="bancalyt-scratch-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder, and read back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
