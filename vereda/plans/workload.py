"""The registered queries: every operator over series, places and messages that are derived
from the whole test tables.

Orders give monthly series, events give daily series and single points, line items give one
short series per part, customers are places and their orders the population. All
groups that are collected into one payload are pages of a fixed size.
"""

import datetime

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F

from vereda import presets
from vereda.functions import labels
from vereda.functions.conversion import decimal_comma_double, source_from_path
from vereda.operators import grouping, ordered, quality
from vereda.plans import anomalies, gold, serve, silver
from vereda.session import fixed_table, new_folder, park
from vereda.sinks import files, topics
from vereda.sources import jsonl, lake, payloads
from vereda.streaming import ingest, publish as publishing, scoring

# The clock of the derived data: orders end in 2001, events in January 2024.
ORDERS_DAY = datetime.date(2001, 8, 31)
EVENTS_DAY = datetime.date(2024, 1, 31)

# Row key of the test table, then code, name and unit of the series it stands for.
ORDER_SERIES = [
    ("1-URGENT", "433", "IPCA", "% a.m."),
    ("2-HIGH", "189", "IGP-M", "% a.m."),
    ("3-MEDIUM", "432", "INPC", "% a.m."),
    ("4-NOT SPECIFIED", "11", "SELIC", "% a.a."),
    ("5-LOW", "4390", "Credito_Imobiliario_Total", "R$ milhoes"),
]
EVENT_SERIES = [
    ("click", "433", "IPCA", "% a.m."),
    ("purchase", "189", "IGP-M", "% a.m."),
    ("signup", "432", "INPC", "% a.m."),
    ("view", "11", "SELIC", "% a.a."),
    ("error", "7478", "Taxa_Financiamento_Imob", "% a.m."),
]
REGIONS = [
    ("AFRICA", "Sudeste"),
    ("AMERICA", "Sul"),
    ("ASIA", "Centro-Oeste"),
    ("EUROPE", "Norte"),
    ("MIDDLE EAST", "Nordeste"),
]
EVENT_SOURCES = [
    ("click", "bcb"),
    ("purchase", "ibge"),
    ("signup", "ibge_populacao"),
    ("view", "anuncios"),
]
PAGE = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _names(spark, series):
    return fixed_table(spark, series, ["chave", "serie_codigo", "serie_nome", "unidade"])


def _money(column):
    return F.col(column).cast("decimal(18,2)")


def _dated(points):
    return points.withColumns({
        "ano": F.year("data_ref"),
        "mes": F.month("data_ref"),
        "categoria": labels.classify_series(F.col("serie_nome")),
    })


# Series


def monthly_points(spark, sf_dir):
    """Mean order value by priority and month, in units of 100,000."""
    sums = (
        table(spark, sf_dir, "orders")
        .groupBy(
            F.col("o_orderpriority").alias("chave"),
            F.trunc("o_orderdate", "month").alias("data_ref"),
        )
        .agg(F.sum(_money("o_totalprice")).alias("soma"), F.count(F.lit(1)).alias("pontos"))
    )
    value = F.col("soma").cast("double") / F.col("pontos") / F.lit(1e5)
    points = sums.join(_names(spark, ORDER_SERIES), "chave").select(
        "serie_codigo", "serie_nome", "unidade", "data_ref", value.alias("valor")
    )
    return park(_dated(points), "pontos")


def event_points(spark, sf_dir):
    """Every event as one point; the event id is its message position."""
    events = table(spark, sf_dir, "events")
    points = events.join(
        _names(spark, EVENT_SERIES), F.col("event_type") == F.col("chave")
    ).select(
        "serie_codigo", "serie_nome", "unidade",
        F.to_date("ts").alias("data_ref"),
        F.col("value").alias("valor"),
        F.col("ts").cast("timestamp").alias("kafka_timestamp"),
        F.lit(0).alias("kafka_partition"),
        F.col("event_id").alias("kafka_offset"),
    )
    return _dated(points)


def part_points(spark, sf_dir):
    """Line value by part and month, in hundreds: many short series."""
    sums = (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("serie_nome"),
            F.trunc("l_shipdate", "month").alias("data_ref"),
        )
        .agg(F.sum(_money("l_extendedprice")).alias("soma"))
    )
    value = F.col("soma").cast("double") / F.lit(1e2)
    points = sums.select(
        F.lit("0").alias("serie_codigo"), "serie_nome", F.lit("R$").alias("unidade"),
        "data_ref", value.alias("valor"),
    )
    return park(_dated(points), "pontos")


def monthly_silver(spark, sf_dir):
    return silver.silver_indicators(monthly_points(spark, sf_dir), ORDERS_DAY, stable=True)


def monthly_table(spark, sf_dir):
    """The silver model as the stored table that gold, reads and checks share."""
    return park(monthly_silver(spark, sf_dir), "silver")


def event_silver(spark, sf_dir):
    return silver.silver_indicators(event_points(spark, sf_dir), EVENTS_DAY, stable=True)


def _columns(df, *drop):
    return df.drop("processado_em", "atualizado_em", "detectado_em", "ordem", *drop)


# Places


def geographic_records(spark, sf_dir):
    regions = fixed_table(spark, REGIONS, ["r_name", "regiao"])
    return (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .join(regions, "r_name")
        .select(
            F.lit("ibge").alias("fonte"),
            F.col("c_custkey").cast("string").alias("codigo_ibge"),
            F.col("c_name").alias("nome"),
            F.col("n_name").alias("uf"),
            "regiao",
            F.col("c_mktsegment").alias("microrregiao"),
            F.concat_ws("-", "n_name", "c_mktsegment").alias("mesorregiao"),
        )
    )


def demographic_records(spark, sf_dir):
    """Whole units of order value per customer; customers without orders have none."""
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.floor(F.sum(_money("o_totalprice"))).cast("bigint").alias("populacao")
    ).select(
        F.lit("ibge_populacao").alias("fonte"),
        F.col("o_custkey").cast("string").alias("codigo_ibge"),
        F.col("populacao").cast("double").alias("populacao"),
    )


def place_records(spark, sf_dir):
    """Both kinds in one table, with the size label the stream adds."""
    merged = silver.merge_kinds(
        geographic_records(spark, sf_dir), demographic_records(spark, sf_dir)
    )
    return merged.withColumn("porte_municipio", labels.size_bucket(F.col("populacao")))


def places_model(spark, sf_dir):
    return silver.silver_places(place_records(spark, sf_dir), ORDERS_DAY)


def places_table(spark, sf_dir):
    return park(places_model(spark, sf_dir), "silver")


def ranking_model(spark, sf_dir):
    return gold.gold_ranking(places_table(spark, sf_dir), ORDERS_DAY, stable=True)


# Payload documents


def event_payloads(spark, sf_dir):
    """Pages of points as the series service answers them: text with a decimal comma."""
    events = table(spark, sf_dir, "events").join(
        _names(spark, EVENT_SERIES), F.col("event_type") == F.col("chave")
    )
    point = F.struct(
        F.date_format("ts", "dd/MM/yyyy").alias("data"),
        F.regexp_replace(F.col("value").cast("string"), r"\.", ",").alias("valor"),
    )
    page = F.expr(f"event_id div {PAGE}")
    return events.groupBy("serie_codigo", page.alias("pagina")).agg(
        F.to_json(F.collect_list(point)).alias("body")
    )


def place_payloads(spark, sf_dir):
    """Pages of nested place objects."""
    place = F.struct(
        F.col("codigo_ibge").cast("bigint").alias("id"),
        "nome",
        F.struct(
            F.col("microrregiao").alias("nome"),
            F.struct(
                F.col("mesorregiao").alias("nome"),
                F.struct(
                    F.col("uf").alias("sigla"),
                    F.struct(F.col("regiao").alias("nome")).alias("regiao"),
                ).alias("UF"),
            ).alias("mesorregiao"),
        ).alias("microrregiao"),
    )
    page = F.expr(f"bigint(codigo_ibge) div {PAGE}")
    return geographic_records(spark, sf_dir).groupBy(page.alias("pagina")).agg(
        F.to_json(F.collect_list(place)).alias("body")
    )


def population_payloads(spark, sf_dir):
    """One document per place; places without people answer an empty array."""
    people = demographic_records(spark, sf_dir).select("codigo_ibge", "populacao")
    text = F.col("populacao").cast("bigint").cast("string")
    body = F.when(F.col("populacao").isNull(), F.lit("[]")).otherwise(F.concat(
        F.lit('[{"resultados": [{"series": [{"serie": {"2010": "1", "2022": "'), text,
        F.lit('"}}]}]}]'),
    ))
    return geographic_records(spark, sf_dir).join(people, "codigo_ibge", "left").select(
        "codigo_ibge", "nome", body.alias("body")
    )


def _uncollected(df):
    return df.drop("coletado_em", "data_coleta")


def series_points(spark, sf_dir):
    return _uncollected(payloads.series_points(
        event_payloads(spark, sf_dir), payloads.series_catalogue(spark)
    ))


def restrict_to_codes(spark, sf_dir):
    wanted = demographic_records(spark, sf_dir).select("codigo_ibge")
    return payloads.restrict_to_codes(geographic_records(spark, sf_dir), wanted)


def restrict_date_range(spark, sf_dir):
    points = series_points(spark, sf_dir)
    return payloads.restrict_date_range(points, "2024-01-10", "2024-01-20")


def price_texts(spark, sf_dir):
    """Prices as text with a comma, with a point, and with both, which does not parse."""
    text = _money("l_extendedprice").cast("string")
    comma = F.regexp_replace(text, r"\.", ",")
    written = (
        F.when(F.col("l_returnflag") == "A", comma)
        .when(F.col("l_returnflag") == "N", text)
        .otherwise(F.concat(F.lit("1."), comma))
    )
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        decimal_comma_double(written).alias("valor"),
    )


# Lines and messages


def event_lines(spark, sf_dir):
    """One JSON line per event in a file named after its source and day; the lines of
    ``error`` events are cut short and their path names no source."""
    sources = fixed_table(spark, EVENT_SOURCES, ["event_type", "origem"])
    events = table(spark, sf_dir, "events").join(sources, "event_type", "left")
    day = F.date_format("ts", "yyyy-MM-dd")
    path = F.concat_ws(
        "/", F.lit("bruto"), F.concat(F.lit("fonte="), F.col("origem")),
        F.concat(F.lit("dia="), day), F.lit("dados.jsonl"),
    )
    code = F.when(F.col("user_id") % 3 == 0, F.lit("")).otherwise(F.col("user_id").cast("string"))
    series = F.when(F.col("user_id") % 2 == 0, F.lit("")).otherwise(F.col("event_type"))
    line = F.concat(
        F.lit('{"codigo_ibge": "'), code, F.lit('", "serie_codigo": "'), series,
        F.lit('", "corpo": '), F.col("props"),
        F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.lit("}")),
    )
    return events.select(
        "event_id", path.alias("arquivo"), source_from_path(path).alias("fonte"),
        line.alias("linha"),
    )


def to_messages(spark, sf_dir):
    good, _ = jsonl.parse_lines(event_lines(spark, sf_dir))
    return topics.to_messages(good, topics.topic_map(spark), carry=["event_id"])


def parse_lines_rejects(spark, sf_dir):
    return jsonl.parse_lines(event_lines(spark, sf_dir))[1]


def unroutable_sources(spark, sf_dir):
    return topics.unroutable_sources(event_lines(spark, sf_dir), topics.topic_map(spark))


def ingest_counts(spark, sf_dir):
    return topics.ingest_counts(
        jsonl.tag_lines(event_lines(spark, sf_dir)), topics.topic_map(spark)
    )


def keyed_routing(spark, sf_dir):
    """Where a topic keeps the messages of each key: partition, number, first and last."""
    placed = topics.assign_partitions(to_messages(spark, sf_dir), [F.col("event_id")])
    return placed.groupBy("topic", "partition", "key").agg(
        F.count(F.lit(1)).alias("mensagens"), F.min("event_id").alias("primeira"),
        F.max("event_id").alias("ultima"), F.min("offset").alias("primeira_posicao"),
        F.max("offset").alias("ultima_posicao"),
    )


def _published(spark, sf_dir):
    """The raw area in two halves, published after each, and once more with nothing new; the
    first run fails after it has stored its batch. Folders of the rows and of the counts."""
    raw, out, ledger, state = (new_folder(spark, name) for name in ("bruto", "topicos", "totais", "progresso"))
    lines = event_lines(spark, sf_dir).select(
        F.col("linha").alias("value"), F.coalesce("fonte", F.lit("nenhuma")).alias("fonte"),
        F.regexp_extract("arquivo", "dia=([0-9-]+)", 1).alias("dia"), "event_id",
    )

    def publish(after=None):
        routed = publishing.route_lines(publishing.stream_jsonl(spark, raw), topics.topic_map(spark))
        ingest.drain_streams(publishing.write_batches(
            routed, out, state, publishing.destination_counts(), ledger, bounded=True, after=after
        ))

    early = F.col("dia") < "2024-01-16"
    for part in (lines.filter(early), lines.filter(~early)):
        part.drop("event_id").write.mode("append").partitionBy("fonte", "dia").text(raw)
        _fails_once(publish)
    publish()
    return out, ledger


def _fails_once(run):
    def stop(number):
        raise RuntimeError(f"stopped after batch {number}")

    try:
        run(stop)
    except StreamingQueryException as ended:
        if "stopped after batch" not in str(ended):
            raise
    run()


def publish_incremental(spark, sf_dir):
    """Lines of a growing raw area in their topics; no line is sent twice."""
    rows = spark.read.parquet(_published(spark, sf_dir)[0])
    return rows.groupBy("destino", "key", "value").agg(F.count(F.lit(1)).alias("mensagens"))


def publish_totals(spark, sf_dir):
    """The totals that the writes themselves observed."""
    rows = spark.read.parquet(_published(spark, sf_dir)[1])
    return rows.agg(*[
        F.sum(name).alias(name) for name in ("linhas", "mensagens", "rejeitadas", "sem_topico")
    ])


def series_with_rejects(spark, sf_dir):
    """Every message in the lake or among the rejected, through two runs that fail midway."""
    log, out, state = (new_folder(spark, name) for name in ("mensagens", "serie", "progresso"))
    messages = series_messages(spark, sf_dir)
    half = F.col("timestamp") < F.lit("2024-01-16").cast("timestamp")

    def run(after=None):
        source = ingest.log_source(spark, log, ingest.TOPIC_OF_SERIES)
        ingest.drain_streams(publishing.write_batches(
            publishing.route_series(source, EVENTS_DAY), out, state, bounded=True, after=after
        ))

    for part in (messages.filter(half), messages.filter(~half)):
        topics.write_message_log(part, log)
        _fails_once(run)
    return spark.read.parquet(out).select(
        F.col("offset").alias("kafka_offset"), "destino", "motivo", "serie_nome", "valor", "ano"
    )


def scan_jsonl(spark, sf_dir):
    """Places of both kinds written as JSON lines and scanned again."""
    folder = new_folder(spark, "bruto")
    for records in (geographic_records(spark, sf_dir), demographic_records(spark, sf_dir)):
        files.write_jsonl_partitioned(records, folder, ORDERS_DAY)
    lines = jsonl.scan_jsonl(spark, folder).withColumnRenamed("fonte", "pasta")
    good, _ = jsonl.parse_lines(lines, ["fonte", "codigo_ibge", "nome"])
    return good.select("pasta", "fonte", "codigo_ibge", "nome")


def jsonl_partitions(spark, sf_dir):
    """Rows per folder of the raw area."""
    records = place_records(spark, sf_dir)
    return files.jsonl_layout(records, ORDERS_DAY).groupBy(
        "fonte", "ano", "mes", "dia", "cidade"
    ).agg(F.count(F.lit(1)).alias("linhas"))


# Streams


def series_messages(spark, sf_dir):
    """Every event as a series message; values of ``error`` events are broken JSON."""
    points = event_points(spark, sf_dir).withColumns({
        "fonte": F.lit("bcb"),
        "data_ref": F.date_format("data_ref", "dd/MM/yyyy"),
    })
    fields = ["fonte", "serie_codigo", "serie_nome", "unidade", "data_ref", "valor"]
    text = topics.record_value(points, fields)
    broken = F.col("serie_nome") == "Taxa_Financiamento_Imob"
    value = F.when(broken, F.concat(F.lit("x"), text)).otherwise(text)
    return points.select(
        F.col("serie_codigo").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(ingest.TOPIC_OF_SERIES).alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("kafka_timestamp").alias("timestamp"),
    )


def place_messages(spark, sf_dir):
    """Every place record of both kinds as a message."""
    records = silver.merge_kinds(
        geographic_records(spark, sf_dir), demographic_records(spark, sf_dir)
    )
    code = F.col("codigo_ibge")
    return records.select(
        code.cast("binary").alias("key"),
        topics.record_value(records).cast("binary").alias("value"),
        F.lit(ingest.TOPIC_OF_PLACES).alias("topic"),
        F.lit(0).alias("partition"),
        code.cast("bigint").alias("offset"),
        F.lit(ORDERS_DAY).cast("timestamp").alias("timestamp"),
    )


def _series_lake(spark, *batches):
    """Stream message batches through one checkpoint, one bounded run each, and once more
    with nothing new."""
    log, out, state = (new_folder(spark, name) for name in ("mensagens", "serie", "progresso"))
    for batch in [*batches, None]:
        if batch is not None:
            topics.write_message_log(batch, log)
        source = ingest.log_source(spark, log, ingest.TOPIC_OF_SERIES)
        ingest.drain_streams(
            ingest.ingest_series_stream(source, out, state, EVENTS_DAY, bounded=True)
        )
    return lake.scan_lake(spark, out)


def ingest_series_stream(spark, sf_dir):
    return _columns(lake.bronze_series(_series_lake(spark, series_messages(spark, sf_dir))))


def stream_resume(spark, sf_dir):
    """Two halves of the month arrive between runs of the same query."""
    messages = series_messages(spark, sf_dir)
    half = F.col("timestamp") < F.lit("2024-01-16").cast("timestamp")
    rows = lake.bronze_series(
        _series_lake(spark, messages.filter(half), messages.filter(~half))
    )
    return rows.groupBy("serie_nome", "ano").agg(
        F.count(F.lit(1)).alias("linhas"),
        F.countDistinct("kafka_offset").alias("mensagens"),
        F.max("kafka_offset").alias("ultima"),
    )


def ingest_places_stream(spark, sf_dir):
    log, out, state = (new_folder(spark, name) for name in ("mensagens", "lugares", "progresso"))
    topics.write_message_log(place_messages(spark, sf_dir), log)
    source = ingest.log_source(spark, log, ingest.TOPIC_OF_PLACES)
    ingest.drain_streams(
        ingest.ingest_places_stream(source, out, state, ORDERS_DAY, bounded=True)
    )
    return _columns(lake.bronze_places(lake.scan_lake(spark, out)), "kafka_timestamp")


def both_streams(spark, sf_dir):
    """Both queries at once over one message log; rows per table."""
    log = new_folder(spark, "mensagens")
    outs = {name: new_folder(spark, name) for name in ("serie", "lugares")}
    states = {name: new_folder(spark, "progresso") for name in outs}
    topics.write_message_log(series_messages(spark, sf_dir), log)
    topics.write_message_log(place_messages(spark, sf_dir), log)
    ingest.drain_streams(
        ingest.ingest_series_stream(
            ingest.log_source(spark, log, ingest.TOPIC_OF_SERIES), outs["serie"],
            states["serie"], EVENTS_DAY, bounded=True,
        ),
        ingest.ingest_places_stream(
            ingest.log_source(spark, log, ingest.TOPIC_OF_PLACES), outs["lugares"],
            states["lugares"], ORDERS_DAY, bounded=True,
        ),
    )
    series = lake.bronze_series(lake.scan_lake(spark, outs["serie"]))
    places = lake.bronze_places(lake.scan_lake(spark, outs["lugares"]))
    return series.groupBy("fonte").agg(F.count(F.lit(1)).alias("linhas")).unionAll(
        places.groupBy("fonte").agg(F.count(F.lit(1)).alias("linhas"))
    )


def bronze_series(spark, sf_dir):
    """A lake whose first files lack the unit column."""
    folder = new_folder(spark, "lago")
    rows = event_points(spark, sf_dir).withColumns({
        "fonte": F.lit("bcb"), "processado_em": F.lit(EVENTS_DAY).cast("timestamp"),
    }).withColumnsRenamed({"kafka_partition": "partition", "kafka_offset": "offset"})
    old = F.col("data_ref") < F.lit(datetime.date(2024, 1, 11))
    for part in (rows.filter(old).drop("unidade"), rows.filter(~old)):
        lake.log_schema(spark, folder, part.schema)
        part.write.mode("append").partitionBy(*ingest.SERIES_PARTITIONS).parquet(folder)
    return _columns(lake.bronze_series(lake.scan_lake(spark, folder)))


def bronze_places(spark, sf_dir):
    """The two kinds as separate files of one table; each lacks the other's columns."""
    folder = new_folder(spark, "lago")
    stamped = {
        "processado_em": F.lit(ORDERS_DAY).cast("timestamp"),
        "kafka_timestamp": F.lit(ORDERS_DAY).cast("timestamp"),
    }
    for part in (geographic_records(spark, sf_dir),
                 demographic_records(spark, sf_dir).withColumn(
                     "porte_municipio", labels.size_bucket(F.col("populacao")))):
        rows = part.withColumns(stamped)
        lake.log_schema(spark, folder, rows.schema)
        rows.write.mode("append").parquet(folder)
    return _columns(lake.bronze_places(lake.scan_lake(spark, folder)), "kafka_timestamp")


# Indicators


def _history(spark, sf_dir):
    """Event points with neighbours, through the chunked path."""
    return silver.with_history(event_points(spark, sf_dir), stable=True)


def _with_history(columns):
    """A query over the event history; ``columns`` makes its columns once a session is there."""
    def run(spark, sf_dir):
        return _history(spark, sf_dir).select("kafka_offset", "serie_nome", *columns())
    return run


def latest_per_key(spark, sf_dir):
    return grouping.latest_per_key(
        _columns(monthly_table(spark, sf_dir)), ["serie_nome"], ["data_ref", "valor"]
    )


def dedupe_latest(spark, sf_dir):
    """The newest point of each series and day, as after a re-publication."""
    points = event_points(spark, sf_dir).drop("categoria", "kafka_partition")
    return grouping.dedupe_latest(
        points, ["serie_nome", "data_ref"], ["kafka_timestamp", "kafka_offset"]
    )


def interpretation(spark, sf_dir):
    """The market rules over every month, not only the latest."""
    months = monthly_silver(spark, sf_dir).withColumnRenamed("valor", "ultimo_valor")
    return months.select(
        "serie_nome", "data_ref",
        labels.interpretation(F.col("serie_nome")).alias("interpretacao_mercado"),
    )


def panorama_model(spark, sf_dir):
    return gold.gold_panorama(monthly_table(spark, sf_dir), ORDERS_DAY)


# Places, ranks


def _known(spark, sf_dir):
    return places_model(spark, sf_dir).filter(F.col("populacao").isNotNull())


def percentile_by_value(spark, sf_dir):
    ranked = ordered.percent_ranks(_known(spark, sf_dir), "populacao")
    return ranked.select("codigo_ibge", F.round(F.col("percentil") * 100.0, 4).alias("percentil"))


def percentile_by_score(spark, sf_dir):
    ranked = ordered.percent_ranks(_known(spark, sf_dir), "score_relevancia")
    return ranked.select("codigo_ibge", F.round(F.col("percentil") * 100.0, 4).alias("percentil"))


def percentile_of_events(spark, sf_dir):
    """Percent rank of every event value; values repeat."""
    events = table(spark, sf_dir, "events").select("event_id", "value")
    ranked = ordered.percent_ranks(events, "value")
    return ranked.select("event_id", F.round(F.col("percentil") * 100.0, 4).alias("percentil"))


def overall_rank(spark, sf_dir):
    order = [F.col("populacao").desc(), F.col("codigo_ibge").asc()]
    return ordered.row_numbers(_known(spark, sf_dir), order, column="ranking_geral").select(
        "codigo_ibge", "ranking_geral"
    )


def rank_in_group(spark, sf_dir):
    known = _known(spark, sf_dir)
    order = [F.col("populacao").desc(), F.col("codigo_ibge").asc()]
    return ordered.row_numbers(known, order, ["regiao"], "ranking_na_regiao").select(
        "codigo_ibge", "regiao", F.col("ranking_na_regiao").cast("bigint").alias("ranking_na_regiao")
    )


def rank_events_in_group(spark, sf_dir):
    """Rank of every event within its type by value, through the chunked path."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    order = [F.col("value").desc(), F.col("event_id").asc()]
    return ordered.row_numbers(
        events, order, ["event_type"], "posicao", stable=True
    )


# Anomalies


def flagged_events(spark, sf_dir):
    """Event points flagged by their own value instead of a forest score."""
    points = event_points(spark, sf_dir).select(
        "serie_nome", "data_ref", "valor", "kafka_offset",
        F.round(F.col("valor") * -1.0, 2).alias("_score"),
    )
    return anomalies.grade(park(points, "pontos"), "_score").withColumn(
        "variacao_pct", F.col("valor")
    )


def flagged_months(spark, sf_dir):
    months = park(silver.enough_history(monthly_silver(spark, sf_dir)), "historia")
    scored = anomalies.min_history(months).withColumn("_score", F.col("variacao_absoluta"))
    return anomalies.grade(park(scored, "pontos"), "_score")


def min_history(spark, sf_dir):
    months = silver.silver_indicators(part_points(spark, sf_dir), ORDERS_DAY, stable=True)
    return anomalies.min_history(park(silver.enough_history(months), "historia"))


def zscore(spark, sf_dir):
    months = park(silver.enough_history(monthly_silver(spark, sf_dir)), "historia")
    scaled = anomalies.zscore(months)
    return scaled.select(
        "serie_nome", "data_ref",
        *[F.round(f"z_{name}", 6).alias(f"z_{name}") for name in presets.FEATURES],
    )


def isolation_forest(spark, sf_dir):
    return anomalies.detect_all(monthly_silver(spark, sf_dir), ORDERS_DAY)


def isolation_forest_events(spark, sf_dir):
    """Every event as a point: five long series, scored block by block."""
    return _columns(anomalies.detect_all(
        event_silver(spark, sf_dir), EVENTS_DAY
    ))


def isolation_forest_parts(spark, sf_dir):
    """One forest per part: very many short series."""
    months = silver.silver_indicators(part_points(spark, sf_dir), ORDERS_DAY, stable=True)
    return _columns(anomalies.detect_all(months, ORDERS_DAY))


def anomaly_report(spark, sf_dir):
    """The entries of the written report, one row per series."""
    folder, graded = new_folder(spark, "relatorio"), park(flagged_months(spark, sf_dir), "notas")
    anomalies.write_summary(graded, folder, ORDERS_DAY)
    layout = anomalies.report_by_series(graded).schema
    entries = spark.read.schema(layout).json(f"{folder}/por_serie")
    top = F.transform("top_anomalias", lambda t: F.concat_ws(
        " ", F.date_format(t["data_ref"], "yyyy-MM-dd"), t["severidade"]))
    return entries.select(
        "serie_nome", "total", "anomalias", "pct", F.concat_ws(", ", top).alias("topo")
    )


def score_new_points(spark, sf_dir):
    """Every month arrives again, in two halves, and is scored with the stored forests."""
    models, arrived, out, state = (
        new_folder(spark, name) for name in ("modelos", "chegados", "notas", "progresso"))
    months = monthly_table(spark, sf_dir)
    _, forest = anomalies.score_series(months)
    files.persist_forest(forest, models)
    points = silver.enough_history(months)
    for part in (points.filter("mes <= 6"), points.filter("mes > 6")):
        part.write.mode("append").parquet(arrived)
        stream = spark.readStream.schema(points.schema).parquet(arrived)
        ingest.drain_streams(scoring.score_stream(stream, models, out, state, bounded=True))
    scored = spark.read.parquet(out).filter(F.col(scoring.SCORE).isNotNull())
    return scored.select(
        "serie_nome", "data_ref", F.bround(scoring.SCORE, 4).alias("anomalia_score"))


# Tables and views


def publish_versions(spark, sf_dir):
    """What readers see: a version opened before it is replaced, the one after a run that
    failed midway, and the new one."""
    root = new_folder(spark, "versoes")
    graded = park(flagged_months(spark, sf_dir), "notas")
    early = graded.filter("mes <= 6")

    def tables(rows, fails=False):
        def write(folder):
            rows.write.parquet(f"{folder}/resultados")
            if fails:
                raise RuntimeError("stopped between two tables")
            anomalies.report_by_series(rows).write.parquet(f"{folder}/por_serie")
        return write

    def seen(moment):
        folder = files.current_version(spark, root)
        points = spark.read.parquet(f"{folder}/resultados").groupBy("serie_nome").agg(
            F.count(F.lit(1)).alias("pontos"))
        report = spark.read.parquet(f"{folder}/por_serie").select("serie_nome", "total")
        return points.join(report, "serie_nome").select(
            F.lit(moment).alias("momento"), "serie_nome", "pontos", "total")

    files.publish_version(spark, root, tables(graded))
    opened = seen("aberta")
    try:
        files.publish_version(spark, root, tables(early, fails=True))
    except RuntimeError as stopped:
        if "between two tables" not in str(stopped):
            raise
    failed = seen("falha")
    files.publish_version(spark, root, tables(early))
    return opened.unionByName(failed).unionByName(seen("nova"))


def anomaly_job(spark, sf_dir):
    """The whole job, and once more without enough history, which leaves the results alone."""
    months, name = monthly_table(spark, sf_dir), "ml_anomalias_dos_meses"
    folders = [new_folder(spark, label) for label in ("modelos", "relatorio")]
    place = new_folder(spark, "resultados")
    anomalies.run_job(months, name, *folders, ORDERS_DAY, place)
    anomalies.run_job(months.filter("mes = 1"), name, *folders, ORDERS_DAY, place)
    return _columns(serve.anomaly_table(spark, name))


def persist_model(spark, sf_dir):
    """Trees and sample of every forest that was stored and loaded again."""
    folder = new_folder(spark, "modelos")
    _, forest = anomalies.score_series(monthly_table(spark, sf_dir))
    files.persist_forest(forest, folder)
    return files.load_forest(spark, folder).groupBy("serie_nome").agg(
        F.count_distinct("arvore").alias("arvores"),
        F.max("amostra").cast("bigint").alias("amostra"),
    )


def publish_table(spark, sf_dir):
    """The silver model as a partitioned table, read by its name."""
    months = _columns(monthly_silver(spark, sf_dir))
    place = new_folder(spark, "tabela")
    return files.publish_table(months, "silver_dos_meses", ["categoria"], place)


def publish_view(spark, sf_dir):
    points = event_points(spark, sf_dir).select("kafka_offset", "serie_nome", "valor")
    return files.publish_view(points, "pontos_de_eventos")


def stamp_processed(spark, sf_dir):
    """Places with the processing time that the caller fixed."""
    stamped = F.date_format("processado_em", "yyyy-MM-dd HH:mm:ss")
    return places_model(spark, sf_dir).select("codigo_ibge", stamped.alias("processado_em"))


def latest_event_values(spark, sf_dir):
    """The last point of each series where many share the last date: the last message."""
    latest = gold.latest_indicators(park(event_silver(spark, sf_dir), "silver"))
    return latest.drop("variacao_ultimo_mes")


def run_streams(spark, sf_dir):
    """A bounded series query, waited for and stopped; rows by series."""
    log, out, state = (new_folder(spark, name) for name in ("mensagens", "serie", "progresso"))
    topics.write_message_log(series_messages(spark, sf_dir), log)
    source = ingest.log_source(spark, log, ingest.TOPIC_OF_SERIES)
    ingest.run_streams(
        spark, ingest.ingest_series_stream(source, out, state, EVENTS_DAY, bounded=True)
    )
    return lake.bronze_series(lake.scan_lake(spark, out)).groupBy("serie_nome").agg(
        F.count(F.lit(1)).alias("linhas")
    )


# Quality


def quality_summary(spark, sf_dir):
    """All declared checks over the four model tables."""
    indicators, places = monthly_table(spark, sf_dir), places_table(spark, sf_dir)
    return quality.run_checks({
        "silver_indicators": indicators,
        "silver_places": places,
        "gold_panorama": gold.gold_panorama(indicators, ORDERS_DAY),
        "gold_ranking": park(gold.gold_ranking(places, ORDERS_DAY, stable=True), "gold"),
    })


QUERIES = {
    "gold_panorama": lambda s, d: _columns(panorama_model(s, d)),
    # Payload documents
    "series_points": series_points,
    "decimal_comma_double": price_texts,
    "flatten_places": lambda s, d: _uncollected(payloads.flatten_places(place_payloads(s, d))),
    "extract_population": lambda s, d: _uncollected(
        payloads.extract_population(population_payloads(s, d))),
    "restrict_to_codes": restrict_to_codes,
    "restrict_date_range": restrict_date_range,
    # Lines and messages
    "scan_jsonl": scan_jsonl,
    "jsonl_partitions": jsonl_partitions,
    "source_from_path": lambda s, d: event_lines(s, d).select("event_id", "fonte"),
    "parse_lines_rejects": parse_lines_rejects,
    "to_messages": to_messages,
    "unroutable_sources": unroutable_sources,
    "ingest_counts": ingest_counts,
    "ingest_totals": lambda s, d: topics.ingest_totals(ingest_counts(s, d)),
    "keyed_routing": keyed_routing,
    "publish_incremental": publish_incremental,
    "publish_totals": publish_totals,
    "series_with_rejects": series_with_rejects,
    # Streams and bronze
    "ingest_series_stream": ingest_series_stream,
    "ingest_places_stream": ingest_places_stream,
    "both_streams": both_streams,
    "run_streams": run_streams,
    "stream_resume": stream_resume,
    "bronze_series": bronze_series,
    "bronze_places": bronze_places,
    # Indicators
    "silver_indicators": lambda s, d: _columns(monthly_silver(s, d)),
    "silver_event_points": lambda s, d: _columns(event_silver(s, d)),
    "silver_part_points": lambda s, d: _columns(
        silver.silver_indicators(part_points(s, d), ORDERS_DAY, stable=True)),
    "previous_value": _with_history(lambda: ["valor", "valor_anterior"]),
    "ytd_running_sum": _with_history(
        lambda: ["ano", F.round("soma_ano", 4).alias("soma_ano")]),
    "abs_change": _with_history(lambda: [
        labels.abs_change(F.col("valor"), F.col("valor_anterior")).alias("variacao_absoluta")]),
    "pct_change": _with_history(lambda: [
        labels.pct_change(F.col("valor"), F.col("valor_anterior")).alias("variacao_pct")]),
    "trend_3": _with_history(lambda: [labels.trend_3(
        F.col("valor"), F.col("valor_anterior"), F.col("valor_antes")).alias("tendencia_3m")]),
    "above_target_flag": _with_history(lambda: [labels.above_target_flag(
        F.col("serie_nome"), F.col("soma_ano")).alias("acima_meta_inflacao")]),
    "classify_series": lambda s, d: event_points(s, d).groupBy("serie_nome", "categoria").agg(
        F.count(F.lit(1)).alias("pontos")),
    "latest_per_key": latest_per_key,
    "dedupe_latest": dedupe_latest,
    "annual_summary": lambda s, d: grouping.annual_summary(monthly_silver(s, d)),
    "interpretation": interpretation,
    # Places
    "merge_kinds": lambda s, d: silver.merge_kinds(
        geographic_records(s, d), demographic_records(s, d)),
    "split_by_kind": lambda s, d: silver.merge_kinds(
        *silver.split_by_kind(place_records(s, d))).select(
            "fonte", "codigo_ibge", "uf", "populacao"),
    "silver_places": lambda s, d: _columns(places_model(s, d)),
    "size_bucket": lambda s, d: places_model(s, d).groupBy("porte_municipio").agg(
        F.count(F.lit(1)).alias("lugares")),
    "relevance_score": lambda s, d: places_model(s, d).groupBy("score_relevancia").agg(
        F.count(F.lit(1)).alias("lugares")),
    "market_profile": lambda s, d: places_model(s, d).groupBy("regiao", "perfil_mercado").agg(
        F.count(F.lit(1)).alias("lugares")),
    "percentile_by_value": percentile_by_value,
    "percentile_by_score": percentile_by_score,
    "percentile_of_events": percentile_of_events,
    "overall_rank": overall_rank,
    "rank_in_group": rank_in_group,
    "rank_events_in_group": rank_events_in_group,
    "composite_score": lambda s, d: ranking_model(s, d).select(
        "codigo_ibge", "percentil_populacao", "score_atratividade"),
    "gold_ranking": lambda s, d: _columns(gold.by_score(ranking_model(s, d))),
    # Read functions
    "list_indicators": lambda s, d: serve.list_indicators(panorama_model(s, d)),
    "market_panorama": lambda s, d: serve.market_panorama(panorama_model(s, d)),
    "series_history": lambda s, d: serve.series_history(monthly_table(s, d), "ipca", 1997, 1999),
    "latest_value": lambda s, d: serve.latest_value(monthly_table(s, d), "Selic"),
    "place_ranking": lambda s, d: serve.place_ranking(ranking_model(s, d), "sudeste", limit=50),
    "list_anomalies": lambda s, d: serve.list_anomalies(
        flagged_months(s, d), "igp-m", "alta", limit=20),
    "anomaly_summary": lambda s, d: serve.anomaly_summary(flagged_events(s, d)),
    # Anomalies
    "distinct_series": lambda s, d: anomalies.distinct_series(part_points(s, d)),
    "min_history": min_history,
    "zscore": zscore,
    "minmax_100": lambda s, d: flagged_events(s, d).select("kafka_offset", "anomalia_score_norm"),
    "contamination_threshold": lambda s, d: flagged_events(s, d).select(
        "kafka_offset", "serie_nome", "anomalia"),
    "severity_bucket": lambda s, d: flagged_events(s, d).select("kafka_offset", "severidade"),
    "isolation_forest": lambda s, d: _columns(isolation_forest(s, d)),
    "isolation_forest_events": isolation_forest_events,
    "isolation_forest_parts": isolation_forest_parts,
    "score_new_points": score_new_points,
    "top_anomalies": lambda s, d: anomalies.top_anomalies(flagged_months(s, d)),
    "anomaly_report": anomaly_report,
    "anomaly_job": anomaly_job,
    "persist_model": persist_model,
    "report_totals": lambda s, d: anomalies.report_totals(flagged_events(s, d)),
    # Tables, views, clock
    "publish_table": publish_table,
    "publish_versions": publish_versions,
    "publish_view": publish_view,
    "stamp_processed": stamp_processed,
    "latest_event_values": latest_event_values,
    # Quality
    "dq_not_null": lambda s, d: quality.not_null(
        places_model(s, d), "populacao").select("codigo_ibge", "uf"),
    "dq_unique": lambda s, d: quality.unique(
        event_points(s, d).withColumn("valor", F.col("valor").cast("decimal(18,2)")), "valor"),
    "dq_accepted_values": lambda s, d: quality.accepted_values(
        monthly_silver(s, d), "tendencia_3m", [presets.RISING, presets.FALLING]),
    "quality_summary": quality_summary,
}
