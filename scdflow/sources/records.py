"""Sources of change records, as streams and as batches."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scdflow.schemas import RECORD, TOPICS

#: Size of a row group of the files that `write_files` leaves.
GROUP_BYTES = 16 << 20


def file_stream(
    spark: SparkSession, folder: str, kind: str = "parquet", max_files: int | None = None
) -> DataFrame:
    """Records from files that arrive in a folder; `max_files` bounds a batch."""
    reader = spark.readStream.schema(RECORD).format(kind)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def write_files(records: DataFrame, folder: str) -> None:
    """Records as files for `file_stream`.

    A task reads whole row groups. They are small, so that a batch of few files, however large,
    has work for all cores and not for one a file.
    """
    records.write.option("parquet.block.size", GROUP_BYTES).parquet(folder)


def kafka_stream(
    spark: SparkSession, servers: str, max_offsets: int | None = None, topics=TOPICS
) -> DataFrame:
    """Records from the change topics, from their start. Needs the Kafka connector."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
    )
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return from_kafka(reader.load())


def from_kafka(rows: DataFrame) -> DataFrame:
    return rows.select(
        "topic",
        "partition",
        "offset",
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
    )


def with_epoch_time(rows: DataFrame) -> DataFrame:
    """Records whose `timestamp` is epoch milliseconds; null stays null."""
    return rows.withColumn(
        "timestamp", F.timestamp_millis(F.col("timestamp").cast("bigint")).cast("timestamp_ntz")
    )


def table_over_jdbc(
    spark: SparkSession, url: str, table: str, key: str, bounds: tuple[int, int], parts: int, **options
) -> DataFrame:
    """A source table, read in `parts` ranges of its numeric key."""
    return spark.read.jdbc(
        url,
        table,
        column=key,
        lowerBound=bounds[0],
        upperBound=bounds[1],
        numPartitions=parts,
        properties=options,
    )


def snapshot_records(rows: DataFrame, topic: str, key: str, taken_at) -> DataFrame:
    """Rows of a source table as snapshot reads, for a first batch before any change.

    They sit in a partition of their own (-1), at the offset of their key.
    """
    payload = F.struct(F.lit("r").alias("op"), F.struct(*rows.columns).alias("after"))
    return rows.select(
        F.lit(topic).alias("topic"),
        F.lit(-1).alias("partition"),
        F.col(key).cast("bigint").alias("offset"),
        F.lit(taken_at).cast("timestamp_ntz").alias("timestamp"),
        F.col(key).cast("string").alias("key"),
        F.to_json(
            F.struct(payload.alias("payload")), {"ignoreNullFields": "false"}
        ).alias("value"),
    )
