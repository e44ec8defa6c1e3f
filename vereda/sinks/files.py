"""JSON lines, model tables, reports and stored forests."""

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from vereda import presets
from vereda.errors import NotReady
from vereda.session import park
from vereda.sinks.topics import record_value

MODEL_BUCKETS = 64


def jsonl_layout(records: DataFrame, collected_at=None) -> DataFrame:
    """JSON text of each record with the partition columns of the raw area."""
    moment = F.current_timestamp() if collected_at is None else F.lit(collected_at).cast("timestamp")

    def field(name):
        return F.col(name) if name in records.columns else F.lit(None).cast("string")

    city = F.coalesce(
        F.nullif(field("cidade_id"), F.lit("")), field("cidade"), F.lit(presets.UNKNOWN_CITY)
    )
    return records.select(
        record_value(records).alias("value"),
        F.coalesce(field("fonte"), F.lit(presets.DEFAULT_SOURCE)).alias("fonte"),
        F.year(moment).cast("string").alias("ano"),
        F.date_format(moment, "MM").alias("mes"),
        F.date_format(moment, "dd").alias("dia"),
        city.alias("cidade"),
    )


def write_jsonl_partitioned(records: DataFrame, path: str, collected_at=None) -> None:
    """Append records as JSON lines below fonte=/ano=/mes=/dia=/cidade=.

    The text writer is used because the record keeps its own ``fonte`` field; its files end
    in ``.txt``, which ``scan_jsonl`` reads as well.
    """
    layout = jsonl_layout(records, collected_at)
    layout.write.mode("append").partitionBy("fonte", "ano", "mes", "dia", "cidade").text(path)


def publish_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def publish_table(df: DataFrame, name: str, partition_by=(), path=None) -> DataFrame:
    """Rebuild a model table in full, in the warehouse or at ``path``."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def replace_results(df: DataFrame, name: str, path=None) -> bool:
    """Replace a result table, or leave it as it is when there is nothing to put in its place."""
    rows = park(df, "resultados")
    if rows.isEmpty():
        return False
    publish_table(rows, name, path=path)
    return True


def _markers(spark, root):
    """The file system of ``root``, and the markers of its versions in order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_publicadas")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = system.listStatus(path) if system.exists(path) else []
    return system, sorted(entry.getPath().getName() for entry in found)


def publish_version(spark: SparkSession, root: str, write) -> str:
    """Write a new version below ``root`` and make it the current one; returns its folder.

    ``write`` gets a folder nobody has used yet and writes all tables of the version there. Only
    when it has returned does an empty file, made in one step, mark the version as published; its
    name says all, so there is nothing in it to be read half written. Published versions are never
    changed: who reads one goes on reading it while others are written, and a run that
    fails leaves the current one as it is. Of two runs at once the later marker wins.
    """
    name = uuid.uuid4().hex
    folder = f"{root}/versoes/{name}"
    write(folder)
    system, markers = _markers(spark, root)
    number = int(markers[-1].split("-")[0]) + 1 if markers else 1
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_publicadas/{number:012d}-{name}")
    system.create(marker, False).close()
    return folder


def current_version(spark: SparkSession, root: str) -> str:
    """Folder of the version that was published last."""
    _, markers = _markers(spark, root)
    if not markers:
        raise NotReady(f"nothing has been published below {root}")
    return f"{root}/versoes/{markers[-1].split('-')[1]}"


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def _bucket():
    return F.pmod(F.xxhash64("modelo"), F.lit(MODEL_BUCKETS)).cast("int")


def persist_forest(forest: DataFrame, path: str) -> None:
    """Store forest nodes by a hash of the lower-case series name, however many series.

    A forest has a bounded number of nodes, so no name is too much for one task.
    """
    named = forest.withColumn("modelo", F.lower("serie_nome")).withColumn("balde", _bucket())
    named.repartition("balde", "modelo").write.mode("overwrite").partitionBy("balde").parquet(path)


def load_forest(spark: SparkSession, path: str, series=None) -> DataFrame:
    """The stored nodes, or those of one series, whose bucket alone is read."""
    nodes = spark.read.parquet(path)
    if series is None:
        return nodes
    wanted = spark.range(1).select(F.lower(F.lit(series)).alias("modelo")).select("modelo", _bucket())
    name, bucket = wanted.first()
    return nodes.filter((F.col("balde") == bucket) & (F.col("modelo") == name))
