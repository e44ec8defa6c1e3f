"""Silver models: indicators with changes and trends, places with population."""

from pyspark.sql import DataFrame, functions as F

from vereda.functions import labels
from vereda.operators.ordered import ROWS_PER_TASK, ordered_windows

# Message position; it tells points of the same date apart.
TIE_COLUMNS = ["kafka_timestamp", "kafka_partition", "kafka_offset"]


def stamp(as_of=None):
    """Processing time, or the time the caller fixes."""
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def point_order(points: DataFrame):
    """Date order of a series, with ties by message position where it is known."""
    known = [name for name in TIE_COLUMNS if name in points.columns]
    return [F.col("data_ref"), *map(F.col, known)]


def with_history(points: DataFrame, rows_per_task=ROWS_PER_TASK, stable=False) -> DataFrame:
    """Two previous values of each point, the running sum of its year, and its place.

    The sum is exact in 18 decimal digits, so it is the same however the rows are cut.
    ``ordem`` numbers all points by series, date and message.
    """
    exact = points.withColumn("_exato", F.col("valor").cast("decimal(38,18)"))
    history = ordered_windows(
        exact, ["serie_nome"], point_order(points),
        lags={"valor_anterior": ("valor", 1), "valor_antes": ("valor", 2)},
        running={"soma_ano": ("_exato", ["ano"])},
        rows_per_task=rows_per_task, stable=stable, place="ordem",
    )
    return history.drop("_exato").withColumn("soma_ano", F.col("soma_ano").cast("double"))


def silver_indicators(bronze: DataFrame, as_of=None, rows_per_task=ROWS_PER_TASK,
                      stable=False) -> DataFrame:
    """One row per point with changes, year-to-date sum, trend and target flag.

    Changes and the flag come from unrounded values; ``valor`` itself is rounded last.
    ``ordem`` tells points of one date apart: the later message has the greater one. Set
    ``stable`` when ``bronze`` is read from lake files and not computed by a shuffle.
    """
    dated = bronze.filter(F.col("data_ref").isNotNull())
    history = with_history(dated, rows_per_task, stable)
    value, previous, before = F.col("valor"), F.col("valor_anterior"), F.col("valor_antes")
    return history.select(
        "serie_codigo", "serie_nome", "unidade", "categoria", "data_ref", "ano", "mes",
        F.round(value, 4).alias("valor"),
        F.round("soma_ano", 4).alias("acumulado_ano"),
        labels.abs_change(value, previous).alias("variacao_absoluta"),
        labels.pct_change(value, previous).alias("variacao_pct"),
        labels.trend_3(value, previous, before).alias("tendencia_3m"),
        labels.above_target_flag(F.col("serie_nome"), F.col("soma_ano")).alias(
            "acima_meta_inflacao"
        ),
        "ordem",
        stamp(as_of).alias("processado_em"),
    )


def by_time(indicators: DataFrame):
    """Columns that order the points of a series, the last message of a date last."""
    return [name for name in ("data_ref", "ordem") if name in indicators.columns]


def split_by_kind(bronze: DataFrame):
    """Geographic and demographic records of the places table."""
    geographic = bronze.filter((F.col("fonte") == "ibge") & F.col("uf").isNotNull())
    demographic = bronze.filter(
        (F.col("fonte") == "ibge_populacao") & F.col("populacao").isNotNull()
    )
    return geographic, demographic


def silver_places(bronze: DataFrame, as_of=None) -> DataFrame:
    """Geographic records with population, size, score and market profile."""
    geographic, demographic = split_by_kind(bronze)
    places = geographic.select(
        "codigo_ibge", "nome", "uf", "regiao", "microrregiao", "mesorregiao"
    )
    people = demographic.select("codigo_ibge", "populacao", "porte_municipio")
    return places.join(people, "codigo_ibge", "left").select(
        *places.columns, "populacao", "porte_municipio",
        labels.relevance_score(F.col("populacao")).alias("score_relevancia"),
        labels.market_profile(F.col("regiao")).alias("perfil_mercado"),
        stamp(as_of).alias("processado_em"),
    )


def merge_kinds(*records: DataFrame) -> DataFrame:
    """Records of several sources in one table; missing columns are null."""
    first, *rest = records
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def enough_history(indicators: DataFrame) -> DataFrame:
    """Points the anomaly model reads: value and change both known."""
    return indicators.filter(
        F.col("valor").isNotNull() & F.col("variacao_pct").isNotNull()
    ).select(
        "serie_nome", "serie_codigo", "categoria", "data_ref", "ano", "mes", "valor",
        "acumulado_ano", "variacao_pct", "variacao_absoluta", "tendencia_3m",
    )
