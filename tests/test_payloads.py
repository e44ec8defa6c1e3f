import datetime
import json

from pyspark.sql import functions as F

from vereda.sources import payloads

MOMENT = datetime.datetime(2026, 5, 7, 8, 9, 10)


def test_series_points(spark):
    body = json.dumps([{"data": "01/01/2024", "valor": "0,42"}, {"data": "02/01/2024"},
                       {"valor": "x"}, {"data": "03/01/2024", "valor": 1.5}])
    documents = spark.createDataFrame(
        [("433", body), ("11", "<html>"), ("11", "[]"), ("999", body)], "serie_codigo string, body string")
    rows = payloads.series_points(documents, payloads.series_catalogue(spark), MOMENT).collect()
    assert {(r.data_ref, r.valor) for r in rows} == {
        ("01/01/2024", 0.42), ("02/01/2024", None), (None, None), ("03/01/2024", 1.5)}
    assert len(rows) == 4
    assert {(r.fonte, r.serie_codigo, r.serie_nome, r.unidade) for r in rows} == {
        ("bcb", "433", "IPCA", "% a.m.")}
    assert {(r.coletado_em, r.data_coleta) for r in rows} == {
        ("2026-05-07T08:09:10.000000", "2026-05-07")}


def test_catalogue_rows(spark):
    rows = [tuple(r) for r in payloads.series_catalogue(spark).collect()]
    assert ("11", "SELIC", "% a.a.") in rows and len(rows) == 6
    assert payloads.place_codes(spark).count() == 18


def test_flatten_places(spark):
    place = {"id": 3550308, "nome": "São Paulo", "microrregiao": {"nome": "Micro", "mesorregiao": {
        "nome": "Meso", "UF": {"sigla": "SP", "regiao": {"nome": "Sudeste"}}}}}
    documents = spark.createDataFrame([(json.dumps([place, {"id": 1}]),), ("{",)], "body string")
    rows = {r.codigo_ibge: r for r in payloads.flatten_places(documents).collect()}
    assert set(rows) == {"3550308", "1"}
    full = rows["3550308"]
    assert (full.fonte, full.nome, full.uf, full.regiao, full.microrregiao, full.mesorregiao) == (
        "ibge", "São Paulo", "SP", "Sudeste", "Micro", "Meso")
    assert rows["1"].uf is None


def test_extract_population(spark):
    def body(series):
        return json.dumps([{"resultados": [{"series": [{"serie": series}]}]}])

    cases = [body({"2022": "123"}), body({"2010": "9"}), body({"2022": None}), body({"2022": ""}),
             body({"2022": "x"}), "[]", json.dumps([{"resultados": []}]),
             json.dumps([{"resultados": [{"series": []}]}]), "not json", None]
    documents = spark.createDataFrame(
        [(str(i), "n", case) for i, case in enumerate(cases)], "codigo_ibge string, nome string, body string")
    rows = {int(r.codigo_ibge): r.populacao for r in payloads.extract_population(documents).collect()}
    assert rows == {0: 123, **{i: None for i in range(1, len(cases))}}


def test_restrictions(spark):
    places = spark.createDataFrame([("3550308", "a"), ("1", "b")], "codigo_ibge string, nome string")
    kept = payloads.restrict_to_codes(places, payloads.place_codes(spark))
    assert [r.nome for r in kept.collect()] == ["a"]
    points = spark.createDataFrame(
        [("31/12/2014",), ("01/01/2015",), ("02/01/2015",), ("bad",), (None,)], "data_ref string")
    assert payloads.restrict_date_range(points, end="2015-01-01").count() == 1
    assert payloads.restrict_date_range(points).count() == 2
    dated = points.select(F.try_to_date("data_ref", "dd/MM/yyyy").alias("data_ref"))
    assert payloads.restrict_date_range(dated).count() == 2
