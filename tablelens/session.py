"""Session settings the library is tuned for, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


#: Bytes of input that one shuffle partition is meant for.
PARTITION_BYTES = 128 * 1024 * 1024


def build_session(
    app: str = "tablelens", master: str | None = None, input_bytes: int | None = None, **extra: str
) -> SparkSession:
    """A session with SETTINGS; `extra` maps setting names to values and wins.

    With `input_bytes`, the size of the largest input, shuffles start with as
    many partitions as that asks for, and AQE merges the small ones.
    """
    if input_bytes:
        wide = str(max(200, -(-input_bytes // PARTITION_BYTES)))
        extra = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": wide, **extra}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir.

    On a cluster the setting must exist. Only a local master may fall back to
    a folder of this machine, which is what the tests use.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    root = tempfile.mkdtemp(prefix="tablelens-checkpoint-")
    spark.conf.set("spark.checkpoint.dir", root)  # one folder per session, so a restart finds its progress
    return root


def scratch_table(df: DataFrame) -> DataFrame:
    """`df` written once to the shared folder and read back; cuts the lineage of a loop."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/tablelens-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
