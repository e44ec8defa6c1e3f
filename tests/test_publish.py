"""The raw area as a stream, rejected messages, observed totals and routing by key."""

import datetime
import json
from collections import defaultdict

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from vereda.session import new_folder
from vereda.sinks import topics
from vereda.sources import jsonl
from vereda.streaming import ingest, publish

DAY = datetime.date(2024, 6, 30)


def put(spark, folder, lines):
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.mode("append").text(folder)


def run(spark, root, out, ledger, state, after=None):
    routed = publish.route_lines(publish.stream_jsonl(spark, root, files_per_batch=1), topics.topic_map(spark))
    ingest.drain_streams(publish.write_batches(
        routed, out, state, publish.destination_counts(), ledger, bounded=True, after=after))


def test_new_files_only_and_each_line_once(spark):
    root, out, ledger, state = (new_folder(spark, name) for name in "abcd")
    good = ['{"codigo_ibge": "%d"}' % k for k in range(6)]
    put(spark, f"{root}/fonte=bcb/dia=01", good[:3] + ["{broken", '{"a": 1} rest', '{"a": 1}{"b": 2}'])
    put(spark, f"{root}/fonte=outra", ['{"serie_codigo": "7"}'])

    def stop(number):
        raise RuntimeError("after the write, before the commit")

    for _ in range(2):
        with pytest.raises(StreamingQueryException):
            run(spark, root, out, ledger, state, stop)
    run(spark, root, out, ledger, state)
    run(spark, root, out, ledger, state)
    put(spark, f"{root}/fonte=ibge/dia=02", good[3:] + good[:1])
    run(spark, root, out, ledger, state)
    rows = sorted((r.destino, r.key, r.value) for r in spark.read.parquet(out).collect())
    series, places = ingest.TOPIC_OF_SERIES, ingest.TOPIC_OF_PLACES
    wanted = [(series, str(k), good[k]) for k in range(3)] + [(places, str(k), good[k]) for k in (3, 4, 5, 0)]
    wanted += [("sem_topico", "7", '{"serie_codigo": "7"}')]
    wanted += [("rejeitada", None, line) for line in ("{broken", '{"a": 1} rest', '{"a": 1}{"b": 2}')]
    assert rows == sorted(wanted, key=lambda row: (row[0], row[1] or "", row[2]))
    seen = spark.read.parquet(ledger)
    totals = seen.agg(*[F.sum(name) for name in ("linhas", "mensagens", "rejeitadas", "sem_topico")]).first()
    assert tuple(totals) == (11, 7, 3, 1) and seen.count() == 3
    assert {r.lote for r in seen.collect()} == {r.lote for r in spark.read.parquet(out).collect()}


def test_every_message_is_taken_or_rejected(spark):
    log, out, state = (new_folder(spark, name) for name in "abc")

    def point(date, value):
        return json.dumps({"serie_nome": "IPCA", "data_ref": date, "valor": value})

    values = [point("05/01/2024", 0.5), point("1/2/2024", None), "{bad", "", None, "[]", '{"valor": "x"}']
    rows = [("k", value, ingest.TOPIC_OF_SERIES, 0, at, datetime.datetime(2024, 1, 1)) for at, value in enumerate(values)]
    sent = spark.createDataFrame(
        rows, "key string, value string, topic string, partition int, offset long, timestamp timestamp")
    topics.write_message_log(sent.withColumns({name: F.col(name).cast("binary") for name in ("key", "value")}), log)
    source = ingest.log_source(spark, log, ingest.TOPIC_OF_SERIES)
    ingest.drain_streams(publish.write_batches(publish.route_series(source, DAY), out, state, bounded=True))
    got = {r.offset: r for r in spark.read.parquet(out).collect()}
    assert len(got) == len(values)
    assert (got[0].destino, got[0].motivo, got[0].mensagem, got[0].ano) == ("aceita", None, None, 2024)
    assert got[0].categoria == "inflacao" and got[0].data_ref == datetime.date(2024, 1, 5)
    assert {at: r.motivo for at, r in got.items() if at} == {1: "valor", 2: "json", 3: "json", 4: "json", 5: "json", 6: "json"}
    assert all(r.destino == "rejeitada" and r.mensagem == values[at] for at, r in got.items() if at)


def test_a_key_keeps_its_partition_and_order(spark):
    rows = [("t" if at % 5 else "u", "hot" if at % 3 == 0 else f"k{at % 11}", f"v{at}", at) for at in range(400)]
    df = spark.createDataFrame(rows, "topic string, key string, value string, at int").repartition(7)
    placed = topics.assign_partitions(df, [F.col("at")]).collect()
    by_key, by_partition = defaultdict(set), defaultdict(list)
    for r in placed:
        by_key[r.key].add(r.partition)
        by_partition[r.topic, r.partition].append((r.offset, r.at))
    assert all(len(found) == 1 for found in by_key.values()) and {p for _, p in by_partition} == {0, 1, 2}
    for each in by_partition.values():
        assert [offset for offset, _ in sorted(each)] == list(range(len(each)))
        assert [at for _, at in sorted(each)] == sorted(at for _, at in each)


def test_scan_needs_a_matching_file(spark):
    root = new_folder(spark, "vazio")
    put(spark, f"{root}/fonte=bcb", ["{}"])
    assert jsonl.scan_jsonl(spark, root).count() == 1
    with pytest.raises(FileNotFoundError):
        jsonl.scan_jsonl(spark, root, suffix="jsonl")
