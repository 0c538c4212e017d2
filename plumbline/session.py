"""Session settings the operators are written for, and durable checkpoints."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE splits skewed join partitions even where a later step relies on the
# join's partitioning: the extra exchange appears only when skew is found.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only a local session without that setting uses its warehouse instead.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, kind: str = "plumbline") -> str:
    """A fresh path in the shared folder; what is written there goes when the session's JVM ends."""
    path = f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt evenly to the session's number of shuffle partitions, however few files or row groups they come from.

    For narrow rows that heavy work per row follows; the keys should differ from row to row.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def durable(df: DataFrame) -> DataFrame:
    """Write a result to the shared folder and go on from the written table.

    The rows are computed once, later steps read only the columns they need,
    and a lost executor costs a re-read instead of a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
