"""Gold models: current conditions by indicator, attractiveness ranking of places."""

from pyspark.sql import DataFrame, functions as F

from vereda import presets
from vereda.functions import labels
from vereda.operators.grouping import annual_summary, latest_per_key
from vereda.operators.ordered import ROWS_PER_TASK, chunked_windows, percent_ranks, place_rows
from vereda.plans.silver import by_time, stamp


def latest_indicators(indicators: DataFrame) -> DataFrame:
    """Latest point of each series under its panorama names."""
    return latest_per_key(indicators, ["serie_nome"], by_time(indicators)).select(
        "serie_nome", "serie_codigo", "categoria", "unidade",
        F.col("data_ref").alias("ultima_data"),
        F.col("valor").alias("ultimo_valor"),
        "acumulado_ano", "tendencia_3m",
        F.col("variacao_pct").alias("variacao_ultimo_mes"),
    )


def gold_panorama(indicators: DataFrame, as_of=None) -> DataFrame:
    """Latest point of each series with this year's summary and a market reading.

    ``as_of`` sets the current year. Series without data in it keep null summaries.
    """
    latest = latest_indicators(indicators)
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    current = annual_summary(indicators.filter(F.col("ano") == F.year(today))).drop("ano")
    return latest.join(current, "serie_nome", "left").select(
        *latest.columns, "media_anual", "maxima_anual", "minima_anual", "meses_com_dados",
        labels.interpretation(F.col("serie_nome")).alias("interpretacao_mercado"),
        stamp(as_of).alias("atualizado_em"),
    )


def gold_ranking(places: DataFrame, as_of=None, value_weight=presets.VALUE_WEIGHT,
                 score_weight=presets.SCORE_WEIGHT, rows_per_task=ROWS_PER_TASK,
                 stable=False) -> DataFrame:
    """Places by a weighted mean of their population and score percentiles.

    The score never falls as the population grows, so descending population, then code, is
    also the order of the composite. One placing of the rows gives the overall rank, the
    population percentile and, counted chunk by chunk, the rank within the region. Set
    ``stable`` when ``places`` is a stored table.
    """
    if not (value_weight > 0 and score_weight >= 0):
        raise ValueError("the population weight has to be positive, the score weight not negative")
    known = places.filter(F.col("populacao").isNotNull())
    order = [F.col("populacao").desc(), F.col("codigo_ibge").asc()]
    placed = place_rows(known, order, stable)
    ranked = chunked_windows(
        placed.withColumn("_one", F.lit(1).cast("bigint")), ["regiao"],
        running={"ranking_na_regiao": ("_one", [])}, lasts={"_ultima": "populacao"},
        rows_per_task=rows_per_task,
    )
    # Rows after the last row of a population are the smaller ones.
    smaller = (F.col("_total") - F.col("_ultima")).cast("double")
    others = (F.col("_total") - 1).cast("double")
    ranked = ranked.withColumn(
        "_por_valor", F.coalesce(F.try_divide(smaller, others), F.lit(0.0))
    )
    ranked = percent_ranks(ranked, "score_relevancia", "_por_score", placed)
    composite = labels.composite_score(
        F.col("_por_valor"), F.col("_por_score"), value_weight, score_weight
    )
    return ranked.select(
        "codigo_ibge", "nome", "uf", "regiao", "microrregiao", "populacao", "porte_municipio",
        "perfil_mercado", "score_relevancia",
        F.round(F.col("_por_valor") * F.lit(100.0), 1).alias("percentil_populacao"),
        F.round(composite * F.lit(100.0), 1).alias("score_atratividade"),
        F.col("_row").alias("ranking_geral"),
        "ranking_na_regiao",
        stamp(as_of).alias("atualizado_em"),
    )


def by_score(ranking: DataFrame) -> DataFrame:
    """The ranking, best composite first."""
    return ranking.orderBy(F.col("score_atratividade").desc(), F.col("ranking_geral").asc())
