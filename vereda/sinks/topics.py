"""Messages for topics, and the topic sink."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from vereda import presets
from vereda.operators.ordered import row_numbers
from vereda.session import fixed_table


def topic_map(spark: SparkSession, topics=None) -> DataFrame:
    pairs = list((topics or presets.TOPICS).items())
    return fixed_table(spark, pairs, ["fonte", "topic"])


def message_key(fields=presets.KEY_FIELDS, default=presets.DEFAULT_KEY):
    """First key field that is neither null nor empty."""
    present = [F.nullif(F.col(name), F.lit("")) for name in fields]
    return F.coalesce(*present, F.lit(default))


def to_messages(lines: DataFrame, topics: DataFrame, value="linha", carry=()) -> DataFrame:
    """Topic, key and JSON value of every line whose source has a topic."""
    return lines.join(topics, "fonte").select(
        "topic", message_key().alias("key"), F.col(value).alias("value"), *carry
    )


def assign_partitions(messages: DataFrame, order, partitions=presets.TOPIC_PARTITIONS) -> DataFrame:
    """Messages with ``partition`` and ``offset``, numbered from 0 in the given order.

    The partition comes from the key alone, by the first 32 bits of its MD5, so a key never
    moves and its messages keep their order. Offsets are numbered chunk by chunk; a topic whose
    messages share one key is no single task.
    """
    head = F.conv(F.substring(F.md5("key"), 1, 8), 16, 10).cast("bigint")
    placed = messages.withColumn("partition", F.pmod(head, F.lit(partitions)).cast("int"))
    numbered = row_numbers(placed, order, ["topic", "partition"], "offset")
    return numbered.withColumn("offset", F.col("offset") - 1)


def unroutable_sources(lines: DataFrame, topics: DataFrame) -> DataFrame:
    """Files whose source has no topic, or that name no source."""
    return lines.select("arquivo", "fonte").join(topics, "fonte", "left_anti").distinct()


def record_value(df: DataFrame, columns=None):
    """JSON text of a record, nulls written out."""
    return F.to_json(F.struct(*(columns or df.columns)), {"ignoreNullFields": "false"})


def ingest_counts(tagged: DataFrame, topics: DataFrame) -> DataFrame:
    """Messages sent per file of tagged lines. A file that sends none counts zero."""
    sent = F.col("inteira") & F.col("topic").isNotNull()
    return tagged.join(topics, "fonte", "left").groupBy("arquivo").agg(
        F.count_if(sent).alias("mensagens")
    )


def ingest_totals(counts: DataFrame) -> DataFrame:
    """Files and messages of a run."""
    return counts.agg(
        F.count(F.lit(1)).alias("arquivos"),
        F.coalesce(F.sum("mensagens"), F.lit(0)).alias("mensagens"),
    )


def write_topic(messages: DataFrame, servers: str, **options) -> None:
    """Publish topic, key and value to Kafka, where the connector is deployed."""
    messages.select("topic", "key", "value").write.format("kafka").options(
        **{"kafka.bootstrap.servers": servers, "kafka.acks": "all", **options}
    ).save()


def write_message_log(messages: DataFrame, path: str, mode="append") -> None:
    """Store messages with their stream columns as files, in place of a broker."""
    messages.write.mode(mode).partitionBy("topic").parquet(path)
