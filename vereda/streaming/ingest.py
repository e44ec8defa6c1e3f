"""Series and place messages into partitioned lake tables."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from vereda import presets, schemas
from vereda.functions import labels
from vereda.functions.conversion import day_first_date
from vereda.plans.silver import stamp
from vereda.sources import lake

SERIES_PARTITIONS = ["serie_nome", "ano"]
PLACE_PARTITIONS = ["uf"]


def kafka_source(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Messages of one topic from its beginning, where the connector is deployed."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "false")
        .load()
    )


def log_source(spark: SparkSession, path: str, topic: str, files_per_batch=None) -> DataFrame:
    """Messages of one topic from a message log; the frame has the broker's columns."""
    reader = spark.readStream.schema(schemas.MESSAGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path).filter(F.col("topic") == topic)


def decode_series(messages: DataFrame) -> DataFrame:
    """Series records with the message position. A broken value is an all-null record.

    The record is generated, so later filters do not parse the value a second time.
    """
    record = F.from_json(F.col("value").cast("string"), schemas.SERIES_RECORD)
    return messages.select(
        F.inline(F.array(record)), F.col("timestamp").alias("kafka_timestamp"), "partition", "offset"
    )


def decode_places(messages: DataFrame) -> DataFrame:
    """Place records with the message time. A broken value is an all-null record."""
    record = F.from_json(F.col("value").cast("string"), schemas.PLACE_RECORD)
    return messages.select(F.inline(F.array(record)), F.col("timestamp").alias("kafka_timestamp"))


def refine_series(records: DataFrame, as_of=None) -> DataFrame:
    """Drop points without a value; add date parts, processing time and category."""
    return described_series(records.filter(F.col("valor").isNotNull()), as_of)


def described_series(records: DataFrame, as_of=None) -> DataFrame:
    """Series records with date parts, processing time and category."""
    return records.withColumn("data_ref", day_first_date(F.col("data_ref"))).withColumns({
        "ano": F.year("data_ref"),
        "mes": F.month("data_ref"),
        "processado_em": stamp(as_of),
        "categoria": labels.classify_series(F.col("serie_nome")),
    })


def refine_places(records: DataFrame, as_of=None) -> DataFrame:
    """Drop records without a code; add processing time and size."""
    return records.filter(F.col("codigo_ibge").isNotNull()).withColumns({
        "processado_em": stamp(as_of),
        "porte_municipio": labels.size_bucket(F.col("populacao")),
    })


def append_stream_table(rows: DataFrame, path: str, checkpoint: str, partition_by, fmt="parquet",
                        bounded=False):
    """Append a stream to a partitioned table; ``bounded`` stops at the end of the input.

    The logged schema of a Parquet table takes in the stream's before anything is written.
    """
    if fmt == "parquet":
        lake.log_schema(rows.sparkSession, path, rows.schema)
    writer = (
        rows.writeStream.format(fmt).outputMode("append")
        .option("checkpointLocation", checkpoint).partitionBy(*partition_by)
    )
    if bounded:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def ingest_series_stream(messages: DataFrame, path, checkpoint, as_of=None, **sink):
    """Start the series query."""
    rows = refine_series(decode_series(messages), as_of)
    return append_stream_table(rows, path, checkpoint, SERIES_PARTITIONS, **sink)


def ingest_places_stream(messages: DataFrame, path, checkpoint, as_of=None, **sink):
    """Start the places query."""
    rows = refine_places(decode_places(messages), as_of)
    return append_stream_table(rows, path, checkpoint, PLACE_PARTITIONS, **sink)


def run_streams(spark: SparkSession, *queries) -> None:
    """Wait until any of the queries ends, then stop all; also on an interrupt or a failure."""
    try:
        spark.streams.resetTerminated()
        if all(query.isActive for query in queries):
            spark.streams.awaitAnyTermination()
        for query in queries:
            if not query.isActive:
                query.awaitTermination()
    finally:
        for query in queries:
            query.stop()


def drain_streams(*queries) -> None:
    """Wait for bounded queries to take in everything that is there."""
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            query.stop()


TOPIC_OF_SERIES = presets.TOPICS["bcb"]
TOPIC_OF_PLACES = presets.TOPICS["ibge"]
