"""Read functions over the model tables."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from vereda import presets
from vereda.errors import LimitExceeded, NotFound, NotReady
from vereda.plans.silver import by_time

# Columns of the results.
PANORAMA_COLUMNS = [
    "serie_nome", "serie_codigo", "categoria", "unidade", "ultima_data", "ultimo_valor",
    "acumulado_ano", "tendencia_3m", "interpretacao_mercado",
]
POINT_COLUMNS = [
    "data_ref", "ano", "mes", "valor", "acumulado_ano", "variacao_pct", "variacao_absoluta",
    "tendencia_3m",
]
RANKING_COLUMNS = [
    "codigo_ibge", "nome", "uf", "regiao", "populacao", "porte_municipio", "perfil_mercado",
    "score_atratividade", "ranking_geral", "ranking_na_regiao",
]
ANOMALY_COLUMNS = [
    "serie_nome", "data_ref", "valor", "variacao_pct", "anomalia_score", "anomalia_score_norm",
    "severidade",
]


def ci_equals(column, text):
    """Equality that ignores case."""
    return F.upper(F.col(column)) == F.upper(F.lit(text))


def year_range(df: DataFrame, year_from=None, year_to=None) -> DataFrame:
    """Rows within the years; a bound that is absent or 0 does not apply."""
    if year_from:
        df = df.filter(F.col("ano") >= year_from)
    if year_to:
        df = df.filter(F.col("ano") <= year_to)
    return df


def _page(df, limit, most, *order):
    if limit > most:
        raise LimitExceeded(f"at most {most} rows, {limit} asked for")
    return df.orderBy(*order).limit(limit)


def list_indicators(panorama: DataFrame) -> DataFrame:
    """Every indicator with its latest point."""
    return panorama.select(*PANORAMA_COLUMNS).orderBy("categoria", "serie_nome")


def market_panorama(panorama: DataFrame) -> DataFrame:
    """Current conditions: the same rows as ``list_indicators``."""
    return list_indicators(panorama)


def series_exists(indicators: DataFrame, name) -> bool:
    return not indicators.filter(ci_equals("serie_nome", name)).limit(1).isEmpty()


def _require_series(indicators, name):
    if not series_exists(indicators, name):
        raise NotFound(f"no series named {name!r}")


def series_history(indicators: DataFrame, name, year_from=None, year_to=None) -> DataFrame:
    """Points of one series by date."""
    _require_series(indicators, name)
    points = indicators.filter(ci_equals("serie_nome", name))
    order = by_time(points)
    return year_range(points, year_from, year_to).orderBy(*order).select(*POINT_COLUMNS)


def latest_value(indicators: DataFrame, name) -> DataFrame:
    """Latest point of one series: of its last date, the last message."""
    _require_series(indicators, name)
    points = indicators.filter(ci_equals("serie_nome", name))
    order = [F.col(column).desc_nulls_last() for column in by_time(points)]
    return points.orderBy(*order).limit(1).select(*POINT_COLUMNS)


def place_ranking(ranking: DataFrame, region=None, state=None,
                  limit=presets.RANK_PAGE[0]) -> DataFrame:
    """Best places, optionally of one region or state."""
    if region:
        ranking = ranking.filter(ci_equals("regiao", region))
    if state:
        ranking = ranking.filter(ci_equals("uf", state))
    return _page(ranking.select(*RANKING_COLUMNS), limit, presets.RANK_PAGE[1], "ranking_geral")


def anomaly_table(spark: SparkSession, name="ml_anomalias") -> DataFrame:
    """The stored anomaly results."""
    if not spark.catalog.tableExists(name):
        raise NotReady(f"table {name} is missing: run the anomaly model first")
    return spark.table(name)


def list_anomalies(anomalies: DataFrame, series=None, severity=None,
                   limit=presets.ANOMALY_PAGE[0]) -> DataFrame:
    """Anomalous points, lowest score first."""
    rows = anomalies.filter(F.col("anomalia"))
    if series:
        rows = rows.filter(ci_equals("serie_nome", series))
    if severity:
        rows = rows.filter(F.col("severidade") == severity)
    order = [F.col("anomalia_score").asc_nulls_last(), F.col("serie_nome"), F.col("data_ref")]
    return _page(rows.select(*ANOMALY_COLUMNS), limit, presets.ANOMALY_PAGE[1], *order)


def anomaly_summary(anomalies: DataFrame) -> DataFrame:
    """Points, anomalies and their share by series."""
    flagged = F.sum(F.col("anomalia").cast("int"))
    total = F.count(F.lit(1))
    return (
        anomalies.groupBy("serie_nome")
        .agg(
            total.alias("total"),
            flagged.alias("anomalias"),
            F.round(flagged * F.lit(100.0) / total, 2).alias("pct_anomalias"),
        )
        .orderBy(F.col("anomalias").desc(), "serie_nome")
    )
