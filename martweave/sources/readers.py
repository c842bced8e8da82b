"""Batch and stream readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

HOTEL_SEED_SCHEMA = (
    "hotel_id string, hotel_type string, hotel_name string, region string, country string, is_active boolean"
)
RATES_FILE_SCHEMA = "currency_pair string, rate double"


def csv_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV file with a header row and a given schema."""
    return spark.read.csv(path, header=True, schema=schema)


def csv_text_rows(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """CSV file read as text columns, for callers that convert and count what fails."""
    return spark.read.csv(path, header=True, schema=", ".join(f"`{c}` string" for c in columns))


def json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON file holding one array of objects."""
    return spark.read.json(path, schema=schema, multiLine=True)


def exchange_rates(spark: SparkSession, path: str, loaded_at: str) -> DataFrame:
    """Rates file as (currency_pair, exchange_rate, timestamp)."""
    return json_array(spark, path, RATES_FILE_SCHEMA).select(
        "currency_pair",
        F.col("rate").alias("exchange_rate"),
        F.lit(loaded_at).cast("timestamp").alias("timestamp"),
    )


def message_files(
    spark: SparkSession, path: str, max_files: int | None = None, max_bytes: int | None = None
) -> DataFrame:
    """Stream of message files: parquet rows (value string, arrived_at timestamp).

    A batch takes at most `max_files` files or, which does not depend on how the producer cuts
    its files, files of `max_bytes` in all (a larger file alone).
    """
    return _admitting(spark.readStream.schema("value string, arrived_at timestamp"), max_files, max_bytes).parquet(path)


def topic_files(
    spark: SparkSession, path: str, max_files: int | None = None, max_bytes: int | None = None
) -> DataFrame:
    """Stream of topic records kept in files, with the columns a Kafka source gives."""
    reader = spark.readStream.schema("topic string, value string, partition int, offset bigint, timestamp timestamp")
    return _admitting(reader, max_files, max_bytes).parquet(path)


def _admitting(reader: DataStreamReader, max_files: int | None, max_bytes: int | None) -> DataStreamReader:
    if max_files and max_bytes:
        raise ValueError("a batch is bounded by files or by bytes, not by both")
    if max_files:
        return reader.option("maxFilesPerTrigger", max_files)
    return reader.option("maxBytesPerTrigger", max_bytes) if max_bytes else reader


def kafka_topics(spark: SparkSession, servers: str, topics: list[str], options: dict | None = None) -> DataFrame:
    """Kafka stream from the earliest offset; offsets live in the query's checkpoint.

    Needs Spark's Kafka connector on the class path.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
    )
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return reader.load().select("topic", F.col("value").cast("string").alias("value"), "partition", "offset", "timestamp")


def routed_by_user(df: DataFrame, key: str = "user_id") -> DataFrame:
    """All rows of a key in one partition, for sinks that need order per key."""
    return df.repartition(key)
