"""The raw area as a stream: each line of a new file once, in one place, with observed totals.

Every batch writes one table, dealt by where its rows go, to a folder of its own. A batch that
is repeated after a failure replaces that folder, so no row is there twice and none is lost;
the rows that are turned away are in the same write as those that are taken.
"""

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from vereda import schemas
from vereda.sinks.topics import message_key
from vereda.sources import jsonl
from vereda.streaming import ingest

BATCH = "lote"
REJECTED, NO_TOPIC, TAKEN = "rejeitada", "sem_topico", "aceita"
_BROKEN = "_quebrada"


def stream_jsonl(spark: SparkSession, root: str, suffix=jsonl.SUFFIXES, files_per_batch=None) -> DataFrame:
    """Lines of the files that arrive below ``root``, with the columns of ``scan_jsonl``.

    Spark's log of files remembers what was read, so a run takes new files only.
    """
    reader = spark.readStream.option("pathGlobFilter", jsonl.file_glob(suffix))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    text = reader.option("recursiveFileLookup", "true").text(root)
    return jsonl.lines_of(spark, text, root)


def route_lines(lines: DataFrame, topics: DataFrame) -> DataFrame:
    """``destino, key, value, arquivo`` of every line: its topic, or why it has none."""
    tagged = jsonl.tag_lines(lines).join(topics, "fonte", "left")
    place = F.when(~F.col("inteira"), REJECTED).when(F.col("topic").isNull(), NO_TOPIC)
    return tagged.select(
        place.otherwise(F.col("topic")).alias("destino"),
        F.when(F.col("inteira"), message_key()).alias("key"),
        F.col("linha").alias("value"), "arquivo",
    )


def route_series(messages: DataFrame, as_of=None) -> DataFrame:
    """Series messages as lake rows, or as rejected with ``motivo`` and the message itself.

    ``motivo`` is ``json`` for a value that is no record of the schema and ``valor`` for a
    point without a value. The value is parsed once.
    """
    schema = StructType([*schemas.SERIES_RECORD.fields, StructField(_BROKEN, StringType())])
    text = F.col("value").cast("string")
    record = F.from_json(text, schema, {"columnNameOfCorruptRecord": _BROKEN})
    parsed = messages.select(
        F.inline(F.array(record)), F.col("timestamp").alias("kafka_timestamp"), "partition", "offset",
        text.alias("mensagem"),
    )
    taken = F.col("valor").isNotNull()
    # An empty value is no record, but the parser does not call it broken.
    broken = F.col(_BROKEN).isNotNull() | (F.coalesce(F.trim("mensagem"), F.lit("")) == "")
    reason = F.when(~taken, F.when(broken, "json").otherwise("valor"))
    marked = parsed.select(
        "*", reason.alias("motivo"), F.when(taken, TAKEN).otherwise(REJECTED).alias("destino")
    ).withColumn("mensagem", F.when(~taken, F.col("mensagem"))).drop(_BROKEN)
    return ingest.described_series(marked, as_of)


def destination_counts():
    """What a batch of routed lines is counted by."""
    place = F.col("destino")
    return [
        F.count(F.lit(1)).alias("linhas"), F.count_if(place == REJECTED).alias("rejeitadas"),
        F.count_if(place == NO_TOPIC).alias("sem_topico"),
        F.count_if(~place.isin(REJECTED, NO_TOPIC)).alias("mensagens"),
    ]


def write_batches(rows: DataFrame, path: str, checkpoint: str, counts=(), ledger=None, bounded=False, after=None):
    """Append a stream below ``path``, a folder ``lote=`` for every batch, dealt by ``destino``.

    ``counts`` are observed by the write itself, without a second scan, and stored as one row
    for the batch below ``ledger``. ``after`` is called with the number of each batch that is
    stored; if it raises, the batch counts as not done and is repeated by the next run.
    """
    def store(batch, number):
        seen = Observation() if counts else None
        observed = batch.observe(seen, *counts) if counts else batch
        observed.write.mode("overwrite").partitionBy("destino").parquet(f"{path}/{BATCH}={number}")
        if counts:
            row = batch.sparkSession.createDataFrame([seen.get])
            row.coalesce(1).write.mode("overwrite").parquet(f"{ledger}/{BATCH}={number}")
        if after:
            after(number)

    writer = rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    if bounded:
        writer = writer.trigger(availableNow=True)
    return writer.start()
