import datetime
import json

import pytest
from pyspark.sql import functions as F

from vereda.session import new_folder
from vereda.sinks import files, topics
from vereda.sources import jsonl


def write(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_scan_parse_route_count(spark, tmp_path):
    write(tmp_path, "fonte=bcb/ano=2026/dados_1.jsonl",
          '{"serie_codigo": "433", "valor": 1}\n\n{"serie_codigo": "11"\n{"serie_codigo": ""}\n')
    write(tmp_path, "fonte=ibge/dados_2.jsonl",
          '{"codigo_ibge": "1", "serie_codigo": "2", "nome": "São"}\n{"cidade_id": "7", "codigo_ibge": "1"} ')
    write(tmp_path, "fonte=outra/dados_3.jsonl", '{"codigo_ibge": "1"}\n')
    write(tmp_path, "solto.jsonl", '{"codigo_ibge": "1"}\n[1]\n')
    write(tmp_path, "fonte=bcb/dados.json", '{"serie_codigo": "9"}\n')
    lines = jsonl.scan_jsonl(spark, str(tmp_path))
    assert lines.count() == 8
    assert {(r.arquivo, r.fonte) for r in lines.collect()} == {
        ("fonte=bcb/ano=2026/dados_1.jsonl", "bcb"), ("fonte=ibge/dados_2.jsonl", "ibge"),
        ("fonte=outra/dados_3.jsonl", "outra"), ("solto.jsonl", None)}

    good, broken = jsonl.parse_lines(lines)
    assert sorted(r.linha for r in broken.collect()) == ["[1]", '{"serie_codigo": "11"']
    routes = topics.topic_map(spark)
    sent = topics.to_messages(good, routes).collect()
    assert sorted((r.topic, r.key) for r in sent) == [
        ("imoveis.bcb.series", "433"), ("imoveis.bcb.series", "default"),
        ("imoveis.ibge.municipios", "1"), ("imoveis.ibge.municipios", "7")]
    assert '{"codigo_ibge": "1", "serie_codigo": "2", "nome": "São"}' in {r.value for r in sent}
    assert {r.arquivo for r in topics.unroutable_sources(lines, routes).collect()} == {
        "fonte=outra/dados_3.jsonl", "solto.jsonl"}
    counts = topics.ingest_counts(jsonl.tag_lines(lines), routes)
    assert {tuple(r) for r in counts.collect()} == {
        ("fonte=bcb/ano=2026/dados_1.jsonl", 2), ("fonte=ibge/dados_2.jsonl", 2),
        ("fonte=outra/dados_3.jsonl", 0), ("solto.jsonl", 0)}
    assert tuple(topics.ingest_totals(counts).first()) == (4, 4)


def test_jsonl_sink_round_trip(spark):
    folder = new_folder(spark, "bruto")
    records = spark.createDataFrame(
        [("bcb", "IPCA", 1.5, None), ("ibge", "São Paulo", None, "sp"), (None, "x", 2.0, "")],
        "fonte string, nome string, valor double, cidade_id string")
    files.write_jsonl_partitioned(records, folder, datetime.datetime(2026, 5, 7))
    files.write_jsonl_partitioned(records.limit(0), folder, datetime.datetime(2026, 5, 7))
    lines = jsonl.scan_jsonl(spark, folder).collect()
    assert {r.arquivo.rsplit("/", 1)[0] for r in lines} == {
        "fonte=bcb/ano=2026/mes=05/dia=07/cidade=desconhecido",
        "fonte=ibge/ano=2026/mes=05/dia=07/cidade=sp",
        "fonte=anuncios/ano=2026/mes=05/dia=07/cidade=desconhecido"}
    values = {json.loads(r.linha)["nome"]: json.loads(r.linha) for r in lines}
    assert values["IPCA"] == {"fonte": "bcb", "nome": "IPCA", "valor": 1.5, "cidade_id": None}
    assert any("São Paulo" in r.linha for r in lines)


def test_message_log(spark):
    folder = new_folder(spark, "log")
    rows = spark.range(3).select(
        F.lit("t").alias("topic"), F.col("id").cast("string").alias("key"), F.lit("{}").alias("value"))
    topics.write_message_log(rows, folder)
    assert spark.read.parquet(folder).filter("topic = 't'").count() == 3


def test_only_single_objects_are_whole(spark):
    cases = {
        '{"codigo_ibge": "1"}': True, ' {"codigo_ibge": "1", "x": [1, {"y": "}"}]}  ': True,
        '{"codigo_ibge": "1"} junk}': False, '{"a": 1}{"b": 2}': False, '{"a": 1},{"b": 2}': False,
        '{"a": 1}] {"b": 2}': False, '{"a": 1}} {"b": 2}': False, "{'codigo_ibge': '3'}": False,
        '{"a": 1': False, "[1]": False, "3": False, '{"a": 1}, "b": {"c": 2}': False, "{}": True,
        '{"a": 1}],"x":[{}': False, '{"a": 1}],"linha":[{}': False, '{"a": 1}]}junk}': False,
        '{"a": 1}],"0":[]} {}': False, '{"codigo_ibge": "1", "codigo_ibge": "2"}': True, '"{}"': False,
        "null": False, "{}}": False, "[{}]": False, '[1],{"a": {}}': False, '{"a": }': False,
    }
    lines = spark.createDataFrame([("f", "bcb", line) for line in cases], "arquivo string, fonte string, linha string")
    got = {r.linha: r.inteira for r in jsonl.tag_lines(lines).collect()}
    assert got == cases


def test_a_line_is_parsed_once(spark):
    lines = spark.createDataFrame([("f", "bcb", '{"codigo_ibge": "1"}')], "arquivo string, fonte string, linha string")
    sent = topics.to_messages(jsonl.parse_lines(lines)[0], topics.topic_map(spark))
    plan = sent._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and sent.first().key == "1"


def test_paths_that_need_escapes(spark, tmp_path):
    root = tmp_path / "com espaço 100%+a"
    write(root, "fonte=bcb/cidade=São Paulo/dados 1.jsonl", '{"codigo_ibge": "1"}\n')
    lines = jsonl.scan_jsonl(spark, str(root)).collect()
    assert [(r.arquivo, r.fonte) for r in lines] == [("fonte=bcb/cidade=São Paulo/dados 1.jsonl", "bcb")]
    with pytest.raises(FileNotFoundError):
        jsonl.scan_jsonl(spark, str(root), "csv")
