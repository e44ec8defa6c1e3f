import datetime

import pytest
from pyspark.sql import functions as F

from vereda import errors, session
from vereda.plans import gold, serve, silver
from vereda.sinks import files

from test_models import bronze, ranking_input

DAY = datetime.date(2024, 6, 30)


@pytest.fixture(scope="module")
def indicators(spark):
    rows = [("IPCA", f"20{y}-0{m}-01", float(y + m), 10 * y + m) for y in range(20, 25) for m in range(1, 5)]
    return session.park(silver.silver_indicators(bronze(spark, rows), DAY))


def test_history(indicators):
    rows = serve.series_history(indicators, "ipca", 2021, 2022).collect()
    assert [r.ano for r in rows] == [2021] * 4 + [2022] * 4
    assert [r.data_ref for r in rows] == sorted(r.data_ref for r in rows)
    assert serve.series_history(indicators, "IPCA", 0, 0).count() == 20
    assert serve.latest_value(indicators, "Ipca").first().data_ref == datetime.date(2024, 4, 1)
    for read in (serve.series_history, serve.latest_value):
        with pytest.raises(errors.NotFound):
            read(indicators, "nada")


def test_panorama_columns(indicators):
    listed = serve.list_indicators(gold.gold_panorama(indicators, DAY))
    assert listed.columns == serve.PANORAMA_COLUMNS and listed.count() == 1


def test_ranking_pages(spark):
    ranking = session.park(gold.gold_ranking(
        ranking_input(spark, [(f"{i:03}", "AB"[i % 2], float(i)) for i in range(150)]), DAY))
    assert serve.place_ranking(ranking).count() == 20
    page = serve.place_ranking(ranking, "a", "u", 100).collect()
    assert len(page) == 75 and [r.ranking_na_regiao for r in page] == list(range(1, 76))
    with pytest.raises(errors.LimitExceeded):
        serve.place_ranking(ranking, limit=101)


def test_tables(spark):
    with pytest.raises(errors.NotReady):
        serve.anomaly_table(spark, "falta")
    df = spark.range(5).select("id", (F.col("id") % 2).alias("p"))
    files.publish_table(df, "modelo_teste", ["p"])
    assert files.publish_table(df.limit(2), "modelo_teste", ["p"]).count() == 2
    assert serve.anomaly_table(spark, "modelo_teste").count() == 2
    assert files.publish_view(df, "visao_teste").count() == 5


def test_shared_folder(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.new_folder(spark, "a") != session.new_folder(spark, "a")
    rows = [("a'b", None), ('c"d', "e")]
    assert [tuple(r) for r in session.fixed_table(spark, rows, ["x", "y"]).collect()] == rows


def test_shared_folder_is_required_on_a_cluster():
    class Conf(dict):
        def get(self, name, default=None):
            return super().get(name, default)

    class Session:
        conf = Conf({"spark.master": "yarn"})

    with pytest.raises(RuntimeError):
        session.shared_folder(Session)
    Session.conf["spark.checkpoint.dir"] = "hdfs://nn/shared/"
    assert session.shared_folder(Session) == "hdfs://nn/shared"


def test_results_stay_when_a_run_is_empty(spark):
    rows = spark.range(3).selectExpr("id AS valor")
    assert files.replace_results(rows, "resultados_de_teste")
    assert not files.replace_results(rows.limit(0), "resultados_de_teste")
    assert spark.table("resultados_de_teste").count() == 3
    assert files.replace_results(rows.limit(1), "resultados_de_teste")
    assert spark.table("resultados_de_teste").count() == 1
