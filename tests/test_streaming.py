import datetime
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from vereda.plans import silver
from vereda.session import new_folder
from vereda.sinks import topics
from vereda.sources import lake
from vereda.streaming import ingest

DAY = datetime.date(2024, 6, 30)


def messages(spark, values, topic, first=0):
    rows = [(f"k{i}", value, topic, 0, first + i, datetime.datetime(2024, 1, 1)) for i, value in enumerate(values)]
    df = spark.createDataFrame(
        rows, "key string, value string, topic string, partition int, offset long, timestamp timestamp")
    return df.withColumns({name: F.col(name).cast("binary") for name in ("key", "value")})


def point(date, value, name="IPCA"):
    return json.dumps({"fonte": "bcb", "serie_codigo": "433", "serie_nome": name, "unidade": "%",
                       "data_ref": date, "valor": value})


def run_series(spark, log, out, state):
    source = ingest.log_source(spark, log, ingest.TOPIC_OF_SERIES, files_per_batch=1)
    ingest.drain_streams(ingest.ingest_series_stream(source, out, state, DAY, bounded=True))
    return lake.bronze_series(lake.scan_lake(spark, out))


def test_series_stream_resumes(spark):
    log, out, state = (new_folder(spark, name) for name in "abc")
    values = [point("05/01/2024", 0.5), point("1/2/2024", 0.6), point("06/01/2024", "0.7"), "{bad",
              point("07/01/2024", None), point("08/01/2024", 1.5, "SELIC")]
    topics.write_message_log(messages(spark, values, ingest.TOPIC_OF_SERIES), log)
    topics.write_message_log(messages(spark, ['{"codigo_ibge": "1"}'], ingest.TOPIC_OF_PLACES), log)
    rows = run_series(spark, log, out, state)
    assert sorted((r.kafka_offset, r.data_ref, r.ano, r.valor, r.categoria) for r in rows.collect()) == [
        (0, datetime.date(2024, 1, 5), 2024, 0.5, "inflacao"), (1, None, None, 0.6, "inflacao"),
        (5, datetime.date(2024, 1, 8), 2024, 1.5, "juros")]
    assert run_series(spark, log, out, state).count() == 3
    topics.write_message_log(messages(spark, [point("09/01/2024", 2.0)], ingest.TOPIC_OF_SERIES, 10), log)
    rows = run_series(spark, log, out, state)
    assert sorted(r.kafka_offset for r in rows.collect()) == [0, 1, 5, 10]
    assert silver.silver_indicators(rows, DAY).count() == 3


def test_places_stream(spark):
    log, out, state = (new_folder(spark, name) for name in "abc")
    values = ['{"fonte": "ibge", "codigo_ibge": "1", "nome": "São", "uf": "SP", "regiao": "Sudeste"}',
              '{"fonte": "ibge_populacao", "codigo_ibge": "1", "populacao": 100001}',
              '{"fonte": "ibge_populacao", "codigo_ibge": "2", "populacao": null}',
              '{"nome": "sem codigo"}', "x"]
    topics.write_message_log(messages(spark, values, ingest.TOPIC_OF_PLACES), log)
    source = ingest.log_source(spark, log, ingest.TOPIC_OF_PLACES)
    ingest.drain_streams(ingest.ingest_places_stream(source, out, state, DAY, bounded=True))
    rows = lake.bronze_places(lake.scan_lake(spark, out))
    assert sorted((r.fonte, r.codigo_ibge, r.uf, r.porte_municipio) for r in rows.collect()) == [
        ("ibge", "1", "SP", "pequeno"), ("ibge_populacao", "1", None, "médio"),
        ("ibge_populacao", "2", None, "pequeno")]
    assert silver.silver_places(rows, DAY).first().populacao == 100001


def test_run_streams_stops_all(spark):
    log, out, state = (new_folder(spark, name) for name in "abc")
    topics.write_message_log(messages(spark, [point("05/01/2024", 0.5)], ingest.TOPIC_OF_SERIES), log)
    source = ingest.log_source(spark, log, ingest.TOPIC_OF_SERIES)
    ends = ingest.ingest_series_stream(source, f"{out}/1", f"{state}/1", DAY, bounded=True)
    runs_on = ingest.ingest_series_stream(source, f"{out}/2", f"{state}/2", DAY)
    ingest.run_streams(spark, ends, runs_on)
    assert not ends.isActive and not runs_on.isActive


def test_schema_union(spark):
    out = new_folder(spark, "lago")
    spark.range(2).select(F.lit(1).alias("a")).write.parquet(f"{out}/p=1")
    spark.range(2).select(F.lit(1).alias("a"), F.lit("x").alias("b")).write.parquet(f"{out}/p=2")
    rows = lake.scan_lake(spark, out)
    assert sorted((r.p, r.b) for r in rows.distinct().collect()) == [(1, None), (2, "x")]


def test_a_logged_schema_spares_the_footers(spark):
    path = new_folder(spark, "lago")
    old = spark.range(3).withColumn("ano", F.lit(2020))
    new = spark.range(2).select("id", F.lit("x").alias("nome"), F.lit(2021).alias("ano"))
    old.write.partitionBy("ano").parquet(path)  # before there was a log
    for rows in (new, old):
        lake.log_schema(spark, path, rows.schema)
        rows.write.mode("append").partitionBy("ano").parquet(path)
    found = lake.scan_lake(spark, path)
    assert sorted(found.columns) == ["ano", "id", "nome"]
    assert found.count() == 8 and found.filter("nome = 'x' AND ano = 2021").count() == 2
    assert len(lake._log_of(spark, path)[2]) == 1
    with pytest.raises(TypeError):
        lake.log_schema(spark, path, new.withColumn("nome", F.lit(1)).schema)
    (Path(path) / "part-quebrada.parquet").write_text("x")
    assert sorted(lake.scan_lake(spark, path).columns) == ["ano", "id", "nome"]  # no file was opened
