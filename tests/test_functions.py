import datetime
import math

import pytest
from pyspark.sql import functions as F

from vereda.functions import conversion, labels


def column(spark, values, kind, expression):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    return [row.y for row in df.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_decimal_comma_double(spark):
    texts = ["1,5", "1.5", "1.234,56", "", None, "abc", "1_000", "1.5d", "0x1p3", " 2,5\n", "-,5",
             "1e3", "1__0", "inf", "-Infinity", "5."]
    found = column(spark, texts, "string", conversion.decimal_comma_double)
    assert found == [1.5, 1.5, None, None, None, None, 1000.0, None, None, 2.5, -0.5,
                     1000.0, None, math.inf, -math.inf, 5.0]
    assert all(map(math.isnan, column(spark, ["nan", "-NaN"], "string", conversion.decimal_comma_double)))


def test_day_first_date(spark):
    texts = ["05/01/2024", "1/2/2024", "31/02/2024", "2024-01-05", None]
    found = column(spark, texts, "string", conversion.day_first_date)
    assert found == [datetime.date(2024, 1, 5), None, None, None, None]


def test_source_from_path(spark):
    paths = ["fonte=bcb/ano=2026/a.jsonl", "x/fonte=ibge/y.jsonl", "x/y.jsonl", "fonte=/a",
             "xfonte=bcb/a", "fonte=a=b/c"]
    assert column(spark, paths, "string", conversion.source_from_path) == [
        "bcb", "ibge", None, None, None, "a"]


@pytest.mark.parametrize("bounded, expected", [
    (labels.size_bucket, ["pequeno", "pequeno", "médio", "médio", "médio", "médio", "grande",
                          "grande", "metrópole"]),
    (labels.relevance_score, [1, 1, 2, 2, 3, 3, 4, 4, 5]),
])
def test_bounds_are_strict(spark, bounded, expected):
    people = [None, 100000.0, 100001.0, 200000.0, 200001.0, 500000.0, 500001.0, 1000000.0, 1000001.0]
    assert column(spark, people, "double", bounded) == expected


def test_categories_and_profiles(spark):
    names = ["IPCA", "IGP-M", "INPC", "SELIC", "outra", None]
    assert column(spark, names, "string", labels.classify_series) == [
        "inflacao", "inflacao", "inflacao", "juros", "credito_imobiliario", "credito_imobiliario"]
    regions = ["Sudeste", "Sul", "Centro-Oeste", "Norte", None]
    assert column(spark, regions, "string", labels.market_profile) == [
        "mercado_maduro", "mercado_maduro", "mercado_expansao", "mercado_emergente",
        "mercado_emergente"]


def test_interpretation(spark):
    rows = [("SELIC", 10.1, 0.0), ("SELIC", 10.0, 0.0), ("SELIC", None, 0.0), ("IPCA", 1.0, 4.6),
            ("IPCA", 1.0, 4.5), ("IPCA", 1.0, None), ("IGP-M", 0.6, 0.0), ("IGP-M", 0.5, 9.0),
            ("INPC", 99.0, 99.0)]
    df = spark.createDataFrame(rows, "serie string, ultimo_valor double, acumulado_ano double")
    found = [row[0] for row in df.coalesce(1).select(labels.interpretation(F.col("serie"))).collect()]
    neutral = "cenario_neutro"
    assert found == [
        "juros_altos_financiamento_caro", "juros_moderados_financiamento_acessivel", neutral,
        "inflacao_pressionada_reajuste_aluguel_alto", neutral, neutral,
        "igpm_elevado_impacto_contratos_aluguel", neutral, neutral]


def test_severity(spark):
    rows = [(0.0, True), (20.0, True), (20.1, True), (40.0, True), (40.1, True), (100.0, True),
            (5.0, False), (None, False)]
    df = spark.createDataFrame(rows, "nota double, anomalia boolean").coalesce(1)
    found = [r[0] for r in df.select(labels.severity_bucket(F.col("nota"), F.col("anomalia"))).collect()]
    assert found == ["alta", "alta", "média", "média", "baixa", "baixa", "normal", "normal"]
