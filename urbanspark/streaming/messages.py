"""Ticket messages: JSON encoding and decoding, broker options, file replay."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TOPIC = "nyc_violations"


def encode_rows(df: DataFrame, key: str) -> DataFrame:
    """Key and JSON value per row; nulls are written, so every message has all fields."""
    value = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    return df.select(F.col(f"`{key}`").cast("string").alias("key"), value.alias("value"))


def decode_rows(df: DataFrame, schema: StructType | str, keep: list[str] | None = None) -> DataFrame:
    """Fields of the JSON ``value`` as columns, next to the columns named in ``keep``."""
    parsed = F.from_json(F.col("value").cast("string"), schema)
    return df.select(*(keep or []), parsed.alias("__row")).select(*(keep or []), "__row.*")


def broker_options(servers: str, topic: str = TOPIC, group: str | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    if group:
        options["kafka.group.id"] = group
    return options


def read_broker(spark: SparkSession, servers: str, topic: str = TOPIC, group: str | None = None) -> DataFrame:
    """Message stream from a broker, from the earliest offset: key, value, partition, offset."""
    return spark.readStream.format("kafka").options(**broker_options(servers, topic, group)).load()


def write_broker(df: DataFrame, servers: str, checkpoint: str, topic: str = TOPIC):
    """Start sending encoded rows (key, value) of a stream to a broker."""
    return (
        df.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def replay_files(spark: SparkSession, glob: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """Existing Parquet files as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(glob)
