"""Declared schemas of payloads, records and messages."""

from pyspark.sql.types import (
    BinaryType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _record(*fields):
    return StructType([StructField(name, kind, True) for name, kind in fields])


POINTS_PAYLOAD = "array<struct<data:string,valor:string>>"

PLACES_PAYLOAD = (
    "array<struct<id:string,nome:string,microrregiao:struct<nome:string,"
    "mesorregiao:struct<nome:string,UF:struct<sigla:string,regiao:struct<nome:string>>>>>>"
)

POPULATION_PAYLOAD = (
    "array<struct<resultados:array<struct<series:array<struct<serie:map<string,string>>>>>>>"
)

SERIES_RECORD = _record(
    ("fonte", StringType()),
    ("serie_codigo", StringType()),
    ("serie_nome", StringType()),
    ("unidade", StringType()),
    ("data_ref", StringType()),
    ("valor", DoubleType()),
    ("coletado_em", StringType()),
    ("data_coleta", StringType()),
)

PLACE_RECORD = _record(
    ("fonte", StringType()),
    ("codigo_ibge", StringType()),
    ("nome", StringType()),
    ("uf", StringType()),
    ("regiao", StringType()),
    ("microrregiao", StringType()),
    ("mesorregiao", StringType()),
    ("populacao", DoubleType()),
    ("coletado_em", StringType()),
    ("data_coleta", StringType()),
)

MESSAGE = _record(
    ("key", BinaryType()),
    ("value", BinaryType()),
    ("topic", StringType()),
    ("partition", IntegerType()),
    ("offset", LongType()),
    ("timestamp", TimestampType()),
)
