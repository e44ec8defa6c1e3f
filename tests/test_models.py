import datetime

import pytest
from pyspark.sql import functions as F

from vereda.operators import grouping, quality
from vereda.plans import gold, serve, silver

DAY = datetime.date(2024, 6, 30)


def bronze(spark, rows):
    """Rows of (series, date, value, offset)."""
    data = [(name, datetime.date.fromisoformat(date), value, offset) for name, date, value, offset in rows]
    df = spark.createDataFrame(data, "serie_nome string, data_ref date, valor double, kafka_offset long")
    return df.withColumns({
        "serie_codigo": F.lit("1"), "unidade": F.lit("%"), "categoria": F.lit("c"),
        "ano": F.year("data_ref"), "mes": F.month("data_ref"),
    })


def test_silver_indicators(spark):
    rows = [("IPCA", "2023-12-01", 2.0, 0), ("IPCA", "2024-01-01", 4.0, 1), ("IPCA", "2024-02-01", 0.0, 2),
            ("IPCA", "2024-03-01", 1.0, 3), ("IPCA", "2024-04-01", -2.0, 4), ("IPCA", "2024-05-01", -1.0, 5),
            ("so", "2024-01-01", 1.23456, 6)]
    found = silver.silver_indicators(bronze(spark, rows), DAY).orderBy("serie_nome", "data_ref").collect()
    picked = [(r.valor, r.acumulado_ano, r.variacao_absoluta, r.variacao_pct, r.tendencia_3m,
               r.acima_meta_inflacao) for r in found]
    assert picked == [
        (2.0, 2.0, None, None, "estável", False),
        (4.0, 4.0, 2.0, 100.0, "estável", False),
        (0.0, 4.0, -4.0, -100.0, "queda", False),
        (1.0, 5.0, 1.0, None, "estável", True),
        (-2.0, 3.0, -3.0, -300.0, "queda", False),
        (-1.0, 2.0, 1.0, 50.0, "estável", False),
        (1.2346, 1.2346, None, None, "estável", False),
    ]
    assert {r.processado_em for r in found} == {datetime.datetime(2024, 6, 30)}


def test_points_of_one_day_follow_the_message_order(spark):
    rows = [("a", "2024-01-01", 1.0, 2), ("a", "2024-01-01", 5.0, 1), ("a", "2024-01-02", 7.0, 0)]
    found = silver.silver_indicators(bronze(spark, rows)).orderBy("data_ref", "acumulado_ano").collect()
    assert [(r.valor, r.variacao_absoluta) for r in found] == [(5.0, None), (1.0, -4.0), (7.0, 6.0)]


def places(spark):
    geographic = spark.createDataFrame(
        [("1", "A", "SP", "Sudeste"), ("2", "B", "GO", "Centro-Oeste"), ("3", "C", None, "Sul"),
         ("4", "D", "PA", "Norte")], "codigo_ibge string, nome string, uf string, regiao string"
    ).withColumn("fonte", F.lit("ibge"))
    demographic = spark.createDataFrame(
        [("1", 2e6, "metrópole"), ("2", 150000.0, "médio"), ("9", 5.0, "pequeno"), ("4", None, "pequeno")],
        "codigo_ibge string, populacao double, porte_municipio string"
    ).withColumn("fonte", F.lit("ibge_populacao"))
    merged = silver.merge_kinds(geographic, demographic)
    return merged.withColumns({"microrregiao": F.lit("m"), "mesorregiao": F.lit("M")})


def test_silver_places(spark):
    rows = {r.codigo_ibge: r for r in silver.silver_places(places(spark), DAY).collect()}
    assert set(rows) == {"1", "2", "4"}
    shown = {k: (r.populacao, r.porte_municipio, r.score_relevancia, r.perfil_mercado) for k, r in rows.items()}
    assert shown == {"1": (2e6, "metrópole", 5, "mercado_maduro"),
                     "2": (150000.0, "médio", 2, "mercado_expansao"),
                     "4": (None, None, 1, "mercado_emergente")}


def test_gold_panorama(spark):
    rows = [("SELIC", "2024-01-01", 12.0, 0), ("SELIC", "2024-02-01", 11.0, 1),
            ("velha", "2020-01-01", 1.0, 2), ("IPCA", "2024-01-01", 1.0, 3)]
    indicators = silver.silver_indicators(bronze(spark, rows), DAY)
    found = {r.serie_nome: r for r in gold.gold_panorama(indicators, DAY).collect()}
    assert set(found) == {"SELIC", "velha", "IPCA"}
    selic = found["SELIC"]
    assert (selic.ultimo_valor, selic.media_anual, selic.maxima_anual, selic.minima_anual,
            selic.meses_com_dados, selic.interpretacao_mercado) == (
        11.0, 11.5, 12.0, 11.0, 2, "juros_altos_financiamento_caro")
    assert found["velha"].media_anual is None and found["velha"].meses_com_dados is None


def test_annual_mean(spark):
    values = [0.1, 0.2, None, 1e30, float("inf")]
    for kept, wanted in ((values[:2], 0.15), ([0.0001, 0.0002], 0.0002), ([1e30, 1e30], 1e30),
                         ([None], None), ([0.00004, 0.00008], 0.0001)):
        df = spark.createDataFrame([("a", 2024, v) for v in kept], "serie_nome string, ano int, valor double")
        assert grouping.annual_summary(df).first().media_anual == wanted


def ranking_input(spark, rows):
    df = spark.createDataFrame(rows, "codigo_ibge string, regiao string, populacao double")
    from vereda.functions import labels
    return df.withColumns({
        "nome": F.lit("n"), "uf": F.lit("U"), "microrregiao": F.lit("m"),
        "porte_municipio": labels.size_bucket(F.col("populacao")),
        "perfil_mercado": F.lit("p"), "score_relevancia": labels.relevance_score(F.col("populacao")),
    })


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_gold_ranking_matches_pandas(spark, size):
    rows = [(str(i), "ABC"[i % 3], float([10, 150000, 150000, 300000, 2000000, 10][i % 6])) for i in range(24)]
    rows.append(("sem", "A", None))
    found = gold.gold_ranking(ranking_input(spark, rows), DAY, rows_per_task=size).toPandas()
    frame = found.copy()
    of = len(frame) - 1
    p = (frame.populacao.rank(method="min") - 1) / of
    q = (frame.score_relevancia.rank(method="min") - 1) / of
    assert (frame.percentil_populacao - p * 100).abs().max() <= 0.05 + 1e-9
    assert (frame.score_atratividade - (p * 0.6 + q * 0.4) * 100).abs().max() <= 0.05 + 1e-9
    frame["c"] = p * 0.6 + q * 0.4
    ordered = frame.sort_values(["c", "codigo_ibge"], ascending=[False, True])
    assert list(ordered.ranking_geral) == list(range(1, 25))
    within = frame.sort_values(["populacao", "codigo_ibge"], ascending=[False, True])
    assert list(within.ranking_na_regiao) == list(within.groupby("regiao").cumcount() + 1)


def test_gold_ranking_single_and_equal(spark):
    one = gold.gold_ranking(ranking_input(spark, [("1", "A", 5.0)])).first()
    assert (one.percentil_populacao, one.score_atratividade, one.ranking_geral) == (0.0, 0.0, 1)
    same = gold.gold_ranking(ranking_input(spark, [(str(i), "A", 5.0) for i in range(5)]))
    assert sorted((r.codigo_ibge, r.ranking_geral, r.score_atratividade) for r in same.collect()) == [
        (str(i), i + 1, 0.0) for i in range(5)]
    with pytest.raises(ValueError):
        gold.gold_ranking(ranking_input(spark, [("1", "A", 5.0)]), value_weight=0)


def test_score_order(spark):
    ranking = gold.gold_ranking(ranking_input(spark, [(str(i), "A", float(i)) for i in range(9)]))
    scores = [r.score_atratividade for r in gold.by_score(ranking).collect()]
    assert scores == sorted(scores, reverse=True)


def test_latest_and_top(spark):
    df = spark.createDataFrame(
        [("a", 1, 5), ("a", 2, 1), ("a", 2, 3), ("b", None, 9), (None, 4, 4)], "k string, t int, v int")
    assert {tuple(r) for r in grouping.latest_per_key(df, ["k"], ["t", "v"]).collect()} == {
        ("a", 2, 3), ("b", None, 9), (None, 4, 4)}
    assert {tuple(r) for r in grouping.top_per_group(df, ["k"], [F.col("v")], 1).collect()} == {
        ("a", 2, 1), ("b", None, 9), (None, 4, 4)}


def test_quality(spark):
    df = spark.createDataFrame([("a", "alta"), ("a", "subida"), (None, None)], "k string, tendencia_3m string")
    assert quality.not_null(df, "k").count() == 1
    assert [tuple(r) for r in quality.unique(df, "k").collect()] == [("a", 2)]
    assert [tuple(r) for r in quality.accepted_values(df, "tendencia_3m", quality.TRENDS).collect()] == [
        ("subida", 1)]
    checks = [("m", "k", "not_null"), ("m", "k", "unique"), ("m", "tendencia_3m", "accepted_values")]
    assert {tuple(r) for r in quality.run_checks({"m": df}, checks).collect()} == {
        ("m", "k", "not_null", 1), ("m", "k", "unique", 1), ("m", "tendencia_3m", "accepted_values", 1)}
    assert len(quality.CHECKS) == 12


def test_checks_bring_their_values(spark):
    frame = spark.createDataFrame([("azul",), ("rosa",), (None,), ("cinza",)], "cor string")
    checks = [("cores", "cor", "accepted_values", ["azul", "rosa"]), ("cores", "cor", "not_null")]
    found = {r.regra: r.violacoes for r in quality.run_checks({"cores": frame}, checks).collect()}
    assert found == {"accepted_values": 1, "not_null": 1}


def test_points_of_one_date(spark):
    """The last message of the last date counts, not the largest value; same in every read."""
    rows = [("SELIC", "2024-01-01", 9.0, 0), ("SELIC", "2024-02-01", 8.0, 1),
            ("SELIC", "2024-02-01", 3.0, 2)]
    indicators = silver.silver_indicators(bronze(spark, rows), DAY)
    last = gold.gold_panorama(indicators, DAY).first()
    assert (last.ultimo_valor, last.acumulado_ano) == (3.0, 20.0)
    assert (serve.latest_value(indicators, "selic").first().valor) == 3.0
    assert [r.valor for r in serve.series_history(indicators, "selic").collect()] == [9.0, 8.0, 3.0]
