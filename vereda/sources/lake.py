"""Lake tables and the bronze models over them."""

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

# Bronze columns; the stream metadata gets its own names.
SERIES_COLUMNS = [
    "fonte", "serie_codigo", "serie_nome", "unidade", "data_ref", "valor", "categoria", "ano",
    "mes", "processado_em", "kafka_timestamp",
]
SERIES_RENAMES = {"partition": "kafka_partition", "offset": "kafka_offset"}
PLACE_COLUMNS = [
    "fonte", "codigo_ibge", "nome", "uf", "regiao", "microrregiao", "mesorregiao", "populacao",
    "porte_municipio", "processado_em", "kafka_timestamp",
]


SCHEMA_LOG = "_esquema"  # Spark does not list what begins with an underscore


def _log_of(spark, path):
    """The file system of a lake, the folder of its schemas, and their names in order."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{SCHEMA_LOG}")
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [entry.getPath().getName() for entry in system.listStatus(folder)] if system.exists(folder) else []
    return system, folder, sorted(name for name in found if not name.startswith("_"))


def logged_schema(spark: SparkSession, path: str):
    """The schema that the lake's writers have left beside it, or None."""
    system, folder, names = _log_of(spark, path)
    if not names:
        return None
    stream = system.open(spark._jvm.org.apache.hadoop.fs.Path(folder, names[-1]))
    try:
        return StructType.fromJson(json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def _schema_of_files(spark, path):
    """What the files of a lake without a log have, read from all footers this once."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return StructType()
    if all(entry.getPath().getName().startswith(("_", ".")) for entry in system.listStatus(folder)):
        return StructType()
    return spark.read.option("mergeSchema", "true").parquet(path).schema


def log_schema(spark: SparkSession, path: str, schema: StructType) -> StructType:
    """Merge a writer's schema into the lake's, before it writes; a type that differs is an error.

    Each change is a new small file, put in place whole; of two writers that change it at the
    same time one starts again from what the other has left.
    """
    known = logged_schema(spark, path) or _schema_of_files(spark, path)
    types = {field.name: field.dataType for field in known.fields}
    new = []
    for field in schema.fields:
        if field.name not in types:
            new.append(StructField(field.name, field.dataType, True))
        elif types[field.name] != field.dataType:
            raise TypeError(f"{field.name} is {types[field.name].simpleString()} in {path}, "
                            f"not {field.dataType.simpleString()}")
    if not new:
        return known
    merged = StructType([*known.fields, *new])
    system, folder, names = _log_of(spark, path)
    file = spark._jvm.org.apache.hadoop.fs.Path
    draft = file(folder, f"_{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    try:
        stream.write(bytearray(merged.json().encode("utf-8")))
    finally:
        stream.close()
    place = file(folder, f"{int(names[-1]) + 1 if names else 1:012d}")
    if system.exists(place) or not system.rename(draft, place):
        system.delete(draft, False)
        return log_schema(spark, path, schema)
    return merged


def scan_lake(spark: SparkSession, path: str, fmt="parquet") -> DataFrame:
    """A partitioned lake table; columns missing from some files are null there.

    With a logged schema no footer is read to plan the scan; without one all of them are.
    """
    schema = logged_schema(spark, path)
    if schema is not None:
        return spark.read.format(fmt).schema(schema).load(path)
    return spark.read.format(fmt).option("mergeSchema", "true").load(path)


def bronze_series(lake: DataFrame) -> DataFrame:
    renamed = [F.col(old).alias(new) for old, new in SERIES_RENAMES.items()]
    return lake.filter(F.col("valor").isNotNull()).select(*SERIES_COLUMNS, *renamed)


def bronze_places(lake: DataFrame) -> DataFrame:
    return lake.filter(F.col("codigo_ibge").isNotNull()).select(*PLACE_COLUMNS)
