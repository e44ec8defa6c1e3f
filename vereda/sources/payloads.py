"""Rows from nested JSON documents, one document per response."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from vereda import presets, schemas
from vereda.functions.conversion import day_first_date, decimal_comma_double
from vereda.session import fixed_table


def series_catalogue(spark: SparkSession, series=presets.SERIES) -> DataFrame:
    return fixed_table(spark, series, ["serie_codigo", "serie_nome", "unidade"])


def place_codes(spark: SparkSession, places=presets.PLACES) -> DataFrame:
    return fixed_table(spark, places, ["codigo_ibge", "rotulo"])


def _collected(collected_at):
    moment = F.current_timestamp() if collected_at is None else F.lit(collected_at).cast("timestamp")
    return [
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("coletado_em"),
        F.date_format(moment, "yyyy-MM-dd").alias("data_coleta"),
    ]


def series_points(payloads: DataFrame, catalogue: DataFrame, collected_at=None) -> DataFrame:
    """One record per point of each ``(serie_codigo, body)`` payload.

    A body that does not parse gives no rows; a point without a key gives null there.
    """
    points = payloads.select(
        "serie_codigo",
        F.explode(F.from_json("body", schemas.POINTS_PAYLOAD)).alias("ponto"),
    )
    return points.join(catalogue, "serie_codigo").select(
        F.lit("bcb").alias("fonte"), "serie_codigo", "serie_nome", "unidade",
        F.col("ponto.data").alias("data_ref"),
        decimal_comma_double(F.col("ponto.valor")).alias("valor"),
        *_collected(collected_at),
    )


def flatten_places(payloads: DataFrame, collected_at=None) -> DataFrame:
    """One geographic record per place of each ``body``."""
    places = payloads.select(
        F.explode(F.from_json("body", schemas.PLACES_PAYLOAD)).alias("lugar")
    )
    state = "lugar.microrregiao.mesorregiao.UF"
    return places.select(
        F.lit("ibge").alias("fonte"),
        F.col("lugar.id").alias("codigo_ibge"),
        F.col("lugar.nome").alias("nome"),
        F.col(f"{state}.sigla").alias("uf"),
        F.col(f"{state}.regiao.nome").alias("regiao"),
        F.col("lugar.microrregiao.nome").alias("microrregiao"),
        F.col("lugar.microrregiao.mesorregiao.nome").alias("mesorregiao"),
        *_collected(collected_at),
    )


def extract_population(payloads: DataFrame, period=presets.CENSUS_PERIOD,
                       collected_at=None) -> DataFrame:
    """One demographic record per ``(codigo_ibge, nome, body)`` payload.

    A missing array element, period or value is null, and so is text that is no integer.
    """
    body = F.from_json("body", schemas.POPULATION_PAYLOAD)
    result = F.get(F.get(body, F.lit(0))["resultados"], F.lit(0))
    series = F.get(result["series"], F.lit(0))["serie"]
    people = F.trim(F.try_element_at(series, F.lit(period))).try_cast("bigint")
    return payloads.select(
        F.lit("ibge_populacao").alias("fonte"), "codigo_ibge", "nome",
        people.alias("populacao"),
        *_collected(collected_at),
    )


def restrict_to_codes(records: DataFrame, codes: DataFrame, code="codigo_ibge") -> DataFrame:
    """Records whose code is listed."""
    return records.join(codes.select(code), code, "left_semi")


def restrict_date_range(points: DataFrame, start=presets.HISTORY_START, end=None) -> DataFrame:
    """Points dated from ``start`` to ``end``, today by default."""
    last = F.current_date() if end is None else F.lit(end).cast("date")
    first = F.lit(start).cast("date")
    date = F.col("data_ref")
    if points.schema["data_ref"].dataType.typeName() == "string":
        date = day_first_date(date)
    return points.filter(date.between(first, last))
