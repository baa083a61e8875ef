"""Tables written to the folder that driver and executors share."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`; a temporary folder only if that is unset and Spark is one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="scdflow-")
    return _LOCAL[context.applicationId]


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """`df` written once and read back: a lost executor repeats reads, not the work before.

    Spark also knows the size of what it reads, so it broadcasts only what is small.
    """
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
