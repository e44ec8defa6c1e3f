"""The registered queries as SQL over the test tables, written from the models' meaning."""

import math

from vereda import presets
from vereda.plans import workload

TREES, SAMPLES = presets.TREES, presets.MAX_SAMPLES


def _values(rows):
    return ", ".join("(" + ", ".join(f"'{cell}'" for cell in row) + ")" for row in rows)


def _query(tables, body):
    return "WITH " + ",\n".join(tables) + "\n" + body


def _series(name, rows):
    return f"{name}(chave, serie_codigo, serie_nome, unidade) AS (VALUES {_values(rows)})"


CATEGORY = """CASE WHEN serie_nome IN ('IPCA', 'IGP-M', 'INPC') THEN 'inflacao'
  WHEN serie_nome = 'SELIC' THEN 'juros' ELSE 'credito_imobiliario' END"""
DATED = f"""CAST(year(data_ref) AS INT) AS ano, CAST(month(data_ref) AS INT) AS mes,
  {CATEGORY} AS categoria"""


# Series

MONTHLY = [
    _series("nomes", workload.ORDER_SERIES),
    f"""pontos AS (
  SELECT serie_codigo, serie_nome, unidade, data_ref, valor, {DATED}, 0 AS ordem
  FROM (SELECT o_orderpriority AS chave, CAST(date_trunc('month', o_orderdate) AS DATE) AS data_ref,
          CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) / 1e5 AS valor
        FROM orders GROUP BY 1, 2) JOIN nomes USING (chave))""",
]
EVENTS = [
    _series("nomes", workload.EVENT_SERIES),
    f"""pontos AS (
  SELECT serie_codigo, serie_nome, unidade, CAST(ts AS DATE) AS data_ref, value AS valor,
    ts AS kafka_timestamp, 0 AS kafka_partition,
    event_id AS kafka_offset, {DATED}, ts AS ordem
  FROM events JOIN nomes ON event_type = chave)""",
]
PARTS = [
    f"""pontos AS (
  SELECT '0' AS serie_codigo, serie_nome, 'R$' AS unidade, data_ref, valor, {DATED}, 0 AS ordem
  FROM (SELECT 'P' || l_partkey AS serie_nome, CAST(date_trunc('month', l_shipdate) AS DATE) AS data_ref,
          CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / 1e2 AS valor
        FROM lineitem GROUP BY 1, 2))""",
]


def _historia(tie):
    return f"""historia AS (
  SELECT *, LAG(valor) OVER s AS valor_anterior, LAG(valor, 2) OVER s AS valor_antes,
    SUM(valor) OVER (PARTITION BY serie_nome, ano ORDER BY data_ref{tie}
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS soma_ano
  FROM pontos WHERE data_ref IS NOT NULL
  WINDOW s AS (PARTITION BY serie_nome ORDER BY data_ref{tie}))"""


ABS_CHANGE = "ROUND(valor - valor_anterior, 4)"
PCT_CHANGE = "ROUND((valor - valor_anterior) / NULLIF(ABS(valor_anterior), 0) * 100, 4)"
TREND = """CASE WHEN valor > valor_anterior AND valor > valor_antes THEN 'alta'
    WHEN valor < valor_anterior AND valor < valor_antes THEN 'queda' ELSE 'estável' END"""
ABOVE = "CASE WHEN serie_nome = 'IPCA' AND soma_ano > 4.5 THEN true ELSE false END"

INDICATORS = f"""indicadores AS (
  SELECT serie_codigo, serie_nome, unidade, categoria, data_ref, ano, mes,
    ROUND(valor, 4) AS valor, ROUND(soma_ano, 4) AS acumulado_ano,
    {ABS_CHANGE} AS variacao_absoluta, {PCT_CHANGE} AS variacao_pct,
    {TREND} AS tendencia_3m, {ABOVE} AS acima_meta_inflacao
  FROM historia)"""

BY_DATE, BY_MESSAGE = _historia(""), _historia(", kafka_timestamp, kafka_offset")
MONTHLY_SILVER = [*MONTHLY, BY_DATE, INDICATORS]
EVENT_HISTORY = [*EVENTS, BY_MESSAGE]
EVENT_SILVER = [*EVENT_HISTORY, INDICATORS]
PART_SILVER = [*PARTS, BY_DATE, INDICATORS]

READING = """CASE WHEN serie_nome = 'SELIC' AND ultimo_valor > 10 THEN 'juros_altos_financiamento_caro'
    WHEN serie_nome = 'SELIC' AND ultimo_valor <= 10 THEN 'juros_moderados_financiamento_acessivel'
    WHEN serie_nome = 'IPCA' AND acumulado_ano > 4.5 THEN 'inflacao_pressionada_reajuste_aluguel_alto'
    WHEN serie_nome = 'IGP-M' AND ultimo_valor > 0.5 THEN 'igpm_elevado_impacto_contratos_aluguel'
    ELSE 'cenario_neutro' END"""
# ROUND(AVG(valor), 4) of four-digit positive values in whole ten-thousandths, because the mean
# of twelve such values is often exactly half-way, where binary sums go either way.
ANNUAL = """SELECT serie_nome, ano,
    (2 * SUM(CAST(ROUND(valor * 10000) AS BIGINT)) + COUNT(*)) // (2 * COUNT(*)) / 1e4 AS media_anual,
    ROUND(MAX(valor), 4) AS maxima_anual, ROUND(MIN(valor), 4) AS minima_anual,
    COUNT(*) AS meses_com_dados FROM indicadores GROUP BY serie_nome, ano"""
PANORAMA = [
    *MONTHLY_SILVER,
    f"anual AS ({ANNUAL})",
    """finais AS (SELECT serie_nome, MAX(data_ref) AS ultima_data,
    arg_max(serie_codigo, data_ref) AS serie_codigo, arg_max(categoria, data_ref) AS categoria,
    arg_max(unidade, data_ref) AS unidade, arg_max(valor, data_ref) AS ultimo_valor,
    arg_max(acumulado_ano, data_ref) AS acumulado_ano, arg_max(tendencia_3m, data_ref) AS tendencia_3m,
    arg_max(i, data_ref).variacao_pct AS variacao_ultimo_mes
    FROM indicadores i GROUP BY serie_nome)""",
    "este_ano AS (SELECT * EXCLUDE (ano) FROM anual WHERE ano = 2001)",
    f"""panorama AS (SELECT *, {READING} AS interpretacao_mercado
    FROM finais LEFT JOIN este_ano USING (serie_nome))""",
]
LISTED = _query(PANORAMA, """SELECT serie_nome, serie_codigo, categoria, unidade, ultima_data,
    ultimo_valor, acumulado_ano, tendencia_3m, interpretacao_mercado FROM panorama""")
POINT = """data_ref, ano, mes, valor, acumulado_ano, variacao_pct, variacao_absoluta, tendencia_3m"""

# Places

PLACES = [
    f"regioes(r_name, regiao) AS (VALUES {_values(workload.REGIONS)})",
    """geografico AS (
  SELECT 'ibge' AS fonte, CAST(c_custkey AS VARCHAR) AS codigo_ibge, c_name AS nome, n_name AS uf,
    regiao, c_mktsegment AS microrregiao, n_name || '-' || c_mktsegment AS mesorregiao
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey JOIN regioes USING (r_name))""",
    """demografico AS (
  SELECT 'ibge_populacao' AS fonte, CAST(o_custkey AS VARCHAR) AS codigo_ibge,
    CAST(floor(SUM(CAST(o_totalprice AS DECIMAL(18,2)))) AS DOUBLE) AS populacao
  FROM orders GROUP BY o_custkey)""",
    """registros AS (SELECT * FROM geografico UNION ALL BY NAME SELECT * FROM demografico)""",
]
SIZE = """CASE WHEN populacao > 1000000 THEN 'metrópole' WHEN populacao > 500000 THEN 'grande'
    WHEN populacao > 100000 THEN 'médio' ELSE 'pequeno' END"""
STEPS = [100000, 200000, 500000, 1000000]  # fixed values: each one passed is a point more
PROFILES = [  # fixed values
    ("Sudeste", "mercado_maduro"), ("Sul", "mercado_maduro"), ("Centro-Oeste", "mercado_expansao"),
]
PLACES_MODEL = [
    *PLACES,
    f"perfis(regiao, perfil) AS (VALUES {_values(PROFILES)})",
    f"""lugares AS (
  SELECT g.codigo_ibge, nome, uf, regiao, microrregiao, mesorregiao, populacao,
    CASE WHEN d.codigo_ibge IS NOT NULL THEN {SIZE} END AS porte_municipio,
    1 + COALESCE({" + ".join(f"CAST(populacao > {least} AS INT)" for least in STEPS)}, 0)
      AS score_relevancia,
    COALESCE(perfil, 'mercado_emergente') AS perfil_mercado
  FROM geografico g LEFT JOIN demografico d ON g.codigo_ibge = d.codigo_ibge
  LEFT JOIN perfis USING (regiao))""",
]
RANKING = [
    *PLACES_MODEL,
    """conhecidos AS (FROM lugares WHERE populacao IS NOT NULL)""",
    # A percentile is the share of the other places that are smaller.
    *[f"""menores_{name} AS (
  SELECT {name}, SUM(iguais) OVER (ORDER BY {name}) - iguais AS abaixo
  FROM (SELECT {name}, COUNT(*) AS iguais FROM conhecidos GROUP BY {name}))"""
      for name in ("populacao", "score_relevancia")],
    """percentis AS (
  SELECT c.*, COALESCE(a.abaixo::DOUBLE / NULLIF(outros, 0), 0) AS p,
    COALESCE(b.abaixo::DOUBLE / NULLIF(outros, 0), 0) AS q, p * 0.6 + q * 0.4 AS nota
  FROM conhecidos c JOIN menores_populacao a USING (populacao)
  JOIN menores_score_relevancia b USING (score_relevancia), (SELECT COUNT(*) - 1 AS outros FROM conhecidos))""",
    """ranking AS (
  SELECT * EXCLUDE (p, q, nota, mesorregiao), ROUND(100 * p, 1) AS percentil_populacao,
    ROUND(100 * nota, 1) AS score_atratividade,
    COUNT(*) OVER (ORDER BY nota DESC, codigo_ibge ROWS UNBOUNDED PRECEDING) AS ranking_geral,
    COUNT(*) OVER (PARTITION BY regiao ORDER BY populacao DESC, codigo_ibge ROWS UNBOUNDED PRECEDING)
      AS ranking_na_regiao
  FROM percentis)""",
]

# Lines and messages

LINES = [
    f"origens(event_type, origem) AS (VALUES {_values(workload.EVENT_SOURCES)})",
    """linhas AS (
  SELECT event_id, event_type, origem AS fonte,
    concat_ws('/', 'bruto', 'fonte=' || origem, 'dia=' || strftime(ts, '%Y-%m-%d'), 'dados.jsonl') AS arquivo,
    CASE WHEN user_id % 3 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS codigo,
    CASE WHEN user_id % 2 = 0 THEN '' ELSE event_type END AS serie, props
  FROM events LEFT JOIN origens USING (event_type))""",
    """textos AS (
  SELECT *, '{"codigo_ibge": "' || codigo || '", "serie_codigo": "' || serie || '", "corpo": ' || props
    || CASE WHEN event_type = 'error' THEN '' ELSE '}' END AS linha
  FROM linhas)""",
    """topicos(fonte, topic) AS (VALUES ('bcb', 'imoveis.bcb.series'),
    ('ibge', 'imoveis.ibge.municipios'), ('ibge_populacao', 'imoveis.ibge.municipios'))""",
    """mensagens AS (
  SELECT event_id, topic, linha AS value,
    COALESCE(NULLIF(codigo, ''), NULLIF(serie, ''), 'default') AS key
  FROM textos JOIN topicos USING (fonte) WHERE event_type <> 'error')""",
    """contagens AS (
  SELECT arquivo, CAST(SUM(CASE WHEN topic IS NOT NULL AND event_type <> 'error' THEN 1 ELSE 0 END) AS BIGINT)
    AS mensagens
  FROM textos LEFT JOIN topicos USING (fonte) GROUP BY arquivo)""",
]
DEALT = """destinos AS (
  SELECT t.*, CASE WHEN event_type = 'error' THEN 'rejeitada'
    ELSE COALESCE(topic, 'sem_topico') END AS destino FROM textos t LEFT JOIN topicos USING (fonte))"""

STREAMED = [*EVENTS, "lidos AS (SELECT * FROM pontos WHERE serie_nome <> 'Taxa_Financiamento_Imob')"]
BRONZE = """fonte, serie_codigo, serie_nome, unidade, data_ref, valor, categoria, ano, mes,
    kafka_timestamp, kafka_partition, kafka_offset"""


# Anomalies

def _graded(rows, value, round_score="round_even({}, 4)"):
    return f"""notas AS (
  SELECT *, MIN({value}) OVER s AS menor, MAX({value}) OVER s AS maior,
    quantile_cont({value}, 0.05) OVER s AS limite
  FROM {rows} WINDOW s AS (PARTITION BY serie_nome)),
escalas AS (
  SELECT *, {round_score.format(value)} AS anomalia_score, {value} < limite AS anomalia,
    round_even(({value} - menor) / NULLIF(maior - menor, 0) * 100, 1) AS anomalia_score_norm
  FROM notas),
resultados AS (
  SELECT *, CASE WHEN NOT anomalia THEN 'normal' WHEN anomalia_score_norm <= 20 THEN 'alta'
    WHEN anomalia_score_norm <= 40 THEN 'média' ELSE 'baixa' END AS severidade
  FROM escalas)"""


FLAGGED_EVENTS = [
    *EVENTS,
    "sinais AS (SELECT *, ROUND(valor * -1.0, 2) AS sinal FROM pontos)",
    _graded("sinais", "sinal"),
]
HISTORY = "SELECT * FROM indicadores WHERE valor IS NOT NULL AND variacao_pct IS NOT NULL"
LONG_ENOUGH = f"""longos AS (
  SELECT * EXCLUDE (pontos) FROM (
    SELECT *, COUNT(*) OVER (PARTITION BY serie_nome) AS pontos FROM ({HISTORY}))
  WHERE pontos >= 24)"""
FLAGGED_MONTHS = [*MONTHLY_SILVER, LONG_ENOUGH, _graded("longos", "variacao_absoluta")]
TOPS = """tops AS (
  SELECT serie_nome, ROW_NUMBER() OVER (PARTITION BY serie_nome ORDER BY anomalia_score, data_ref, valor)
    AS posicao, data_ref, valor, variacao_pct, severidade, anomalia_score
  FROM resultados WHERE anomalia QUALIFY posicao <= 3)"""


def _search(n):
    return f"""CASE WHEN {n} <= 1 THEN 0.0 WHEN {n} = 2 THEN 1.0
      ELSE 2 * (ln({n} - 1) + 0.5772156649015329) - 2.0 * ({n} - 1) / {n} END"""


def _unit(start):
    return f"CAST('0x' || substr(h, {start}, 8) AS BIGINT) / 4294967296.0::DOUBLE"


def _forest(silver, trees=TREES):
    """All levels of the forest, for series whose points all fit in one tree's sample."""
    zero = ", ".join(
        f"COALESCE({name}, 0.0) AS f{i}" for i, name in enumerate(presets.FEATURES, 1)
    )
    steps = [*silver, LONG_ENOUGH, f"""n0 AS (
  SELECT *, CAST(arvore_ AS INT) AS arvore, CAST(1 AS BIGINT) AS no FROM (
    SELECT serie_nome, data_ref, {zero}, COUNT(*) OVER (PARTITION BY serie_nome) AS psi FROM longos)
  CROSS JOIN range(1, {trees + 1}) arvores(arvore_))"""]
    spread = ", ".join(f"MIN(f{i}) OVER p AS lo{i}, MAX(f{i}) OVER p AS hi{i}" for i in range(1, 5))
    varying = ", ".join(f"CASE WHEN hi{i} > lo{i} THEN 1 ELSE 0 END AS v{i}" for i in range(1, 5))
    for level in range(math.ceil(math.log2(SAMPLES))):
        steps.append(f"""a{level} AS (
  SELECT *, COUNT(*) OVER p AS n, {spread},
    md5(concat_ws('|', '{presets.SEED}', serie_nome, arvore, no)) AS h
  FROM n{level} WINDOW p AS (PARTITION BY serie_nome, arvore, no)),
b{level} AS (SELECT *, {varying} FROM a{level}),
j{level} AS (SELECT *, floor({_unit(1)} * (v1 + v2 + v3 + v4)) AS j FROM b{level}),
c{level} AS (SELECT *, CASE WHEN n = 1 OR {level} >= ceil(log2(psi)) THEN NULL
    WHEN v1 = 1 AND j = 0 THEN 1 WHEN v2 = 1 AND j = v1 THEN 2 WHEN v3 = 1 AND j = v1 + v2 THEN 3
    WHEN v4 = 1 AND j = v1 + v2 + v3 THEN 4 END AS v FROM j{level}),
d{level} AS (SELECT *, [lo1, lo2, lo3, lo4][v] AS lo, [hi1, hi2, hi3, hi4][v] AS hi,
    [f1, f2, f3, f4][v] AS f FROM c{level}),
e{level} AS (SELECT *, lo + {_unit(9)} * (hi - lo) AS c FROM d{level}),
n{level + 1} AS (SELECT serie_nome, data_ref, f1, f2, f3, f4, psi, arvore,
    CASE WHEN v IS NULL THEN no
      ELSE no * 2 + CASE WHEN f >= CASE WHEN c > lo AND c <= hi THEN c ELSE hi END THEN 1 ELSE 0 END
    END AS no FROM e{level})""")
    last = math.ceil(math.log2(SAMPLES))
    steps.append(f"""folhas AS (SELECT *, COUNT(*) OVER (PARTITION BY serie_nome, arvore, no) AS n FROM n{last}),
medias AS (
  SELECT serie_nome, data_ref, -pow(2, -AVG(floor(log2(no)) + {_search('n')}) / MAX({_search('psi')})) AS escore
  FROM folhas GROUP BY serie_nome, data_ref),
pontuados AS (SELECT longos.*, escore FROM longos JOIN medias USING (serie_nome, data_ref))""")
    steps.append(_graded("pontuados", "escore"))
    return _query(steps, """SELECT serie_nome, serie_codigo, categoria, data_ref, ano, mes, valor,
    variacao_pct, acumulado_ano, anomalia, anomalia_score, anomalia_score_norm, severidade
  FROM resultados""")


def _zscores():
    scaled = ", ".join(
        f"""ROUND((COALESCE({name}, 0) - AVG(COALESCE({name}, 0)) OVER s)
      / COALESCE(NULLIF(stddev_pop(COALESCE({name}, 0)) OVER s, 0), 1), 6) AS z_{name}"""
        for name in presets.FEATURES
    )
    return _query(
        MONTHLY_SILVER,
        f"SELECT serie_nome, data_ref, {scaled} FROM ({HISTORY}) WINDOW s AS (PARTITION BY serie_nome)",
    )


def _checks():
    tables = {
        "silver_indicators": "indicadores", "silver_places": "lugares",
        "gold_panorama": "panorama", "gold_ranking": "ranking",
    }
    # The declared checks.
    declared = [
        ("silver_indicators", "serie_nome", "not_null"),
        ("silver_indicators", "data_ref", "not_null"),
        ("silver_indicators", "valor", "not_null"),
        ("silver_indicators", "tendencia_3m", "accepted_values"),
        ("silver_places", "codigo_ibge", "not_null"),
        ("silver_places", "codigo_ibge", "unique"),
        ("silver_places", "uf", "not_null"),
        ("gold_panorama", "serie_nome", "not_null"),
        ("gold_panorama", "serie_nome", "unique"),
        ("gold_ranking", "codigo_ibge", "not_null"),
        ("gold_ranking", "codigo_ibge", "unique"),
        ("gold_ranking", "score_atratividade", "not_null"),
    ]
    counts = {
        "not_null": "SELECT COUNT(*) FROM {t} WHERE {c} IS NULL",
        "unique": "SELECT COUNT(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL "
                  "GROUP BY {c} HAVING COUNT(*) > 1)",
        "accepted_values": "SELECT COUNT(*) FROM (SELECT DISTINCT {c} FROM {t} "
                           "WHERE {c} NOT IN ('alta', 'queda', 'estável'))",
    }
    body = "\nUNION ALL\n".join(
        f"SELECT '{model}' AS modelo, '{column}' AS coluna, '{rule}' AS regra, "
        f"({counts[rule].format(t=tables[model], c=column)}) AS violacoes"
        for model, column, rule in declared
    )
    return _query([*PANORAMA, *RANKING], body)


def _history(columns):
    return _query(EVENT_HISTORY, f"SELECT kafka_offset, serie_nome, {columns} FROM historia")


def _count_by(tables, source, *columns, alias="lugares"):
    names = ", ".join(columns)
    return _query(tables, f"SELECT {names}, COUNT(*) AS {alias} FROM {source} GROUP BY {names}")


ORACLES = {
    "gold_panorama": _query(PANORAMA, "SELECT * FROM panorama"),
    "series_points": _query(EVENTS, """SELECT 'bcb' AS fonte, serie_codigo, serie_nome, unidade,
      strftime(data_ref, '%d/%m/%Y') AS data_ref, valor FROM pontos"""),
    "decimal_comma_double": """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
      CASE WHEN l_returnflag IN ('A', 'N') THEN l_extendedprice END AS valor FROM lineitem""",
    "flatten_places": _query(PLACES, "SELECT * FROM geografico"),
    "extract_population": _query(PLACES, """SELECT 'ibge_populacao' AS fonte, g.codigo_ibge, g.nome,
      CAST(d.populacao AS BIGINT) AS populacao
      FROM geografico g LEFT JOIN demografico d ON g.codigo_ibge = d.codigo_ibge"""),
    "restrict_to_codes": _query(PLACES, """SELECT * FROM geografico
      WHERE codigo_ibge IN (SELECT codigo_ibge FROM demografico)"""),
    "restrict_date_range": _query(EVENTS, """SELECT 'bcb' AS fonte, serie_codigo, serie_nome, unidade,
      strftime(data_ref, '%d/%m/%Y') AS data_ref, valor FROM pontos
      WHERE data_ref BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'"""),
    "scan_jsonl": _query(PLACES, "SELECT fonte AS pasta, fonte, codigo_ibge, nome FROM registros"),
    "jsonl_partitions": _query(PLACES, """SELECT fonte, '2001' AS ano, '08' AS mes, '31' AS dia,
      'desconhecido' AS cidade, COUNT(*) AS linhas FROM registros GROUP BY fonte"""),
    "source_from_path": _query(LINES, "SELECT event_id, fonte FROM textos"),
    "parse_lines_rejects": _query(LINES, """SELECT event_id, arquivo, fonte, linha FROM textos
      WHERE event_type = 'error'"""),
    "to_messages": _query(LINES, "SELECT topic, key, value, event_id FROM mensagens"),
    "unroutable_sources": _query(LINES, """SELECT DISTINCT arquivo, fonte FROM textos
      WHERE fonte IS NULL OR fonte NOT IN (SELECT fonte FROM topicos)"""),
    "ingest_counts": _query(LINES, "SELECT * FROM contagens"),
    "ingest_totals": _query(LINES, """SELECT COUNT(*) AS arquivos,
      CAST(SUM(mensagens) AS BIGINT) AS mensagens FROM contagens"""),
    "keyed_routing": _query([*LINES, """divididas AS (
  SELECT *, CAST(('0x' || substr(md5(key), 1, 8))::BIGINT % 3 AS INT) AS partition FROM mensagens)""",
    """postas AS (
  SELECT *, row_number() OVER (PARTITION BY topic, partition ORDER BY event_id) - 1 AS posicao
  FROM divididas)"""], """SELECT topic, partition, key, COUNT(*) AS mensagens,
      MIN(event_id) AS primeira, MAX(event_id) AS ultima, MIN(posicao) AS primeira_posicao,
      MAX(posicao) AS ultima_posicao FROM postas GROUP BY topic, partition, key"""),
    "publish_incremental": _query([*LINES, DEALT], """SELECT destino,
      CASE WHEN destino <> 'rejeitada' THEN COALESCE(NULLIF(codigo, ''), NULLIF(serie, ''), 'default') END
        AS key, linha AS value, COUNT(*) AS mensagens FROM destinos GROUP BY ALL"""),
    "publish_totals": _query([*LINES, DEALT], """SELECT COUNT(*) AS linhas,
      COUNT(*) FILTER (destino NOT IN ('rejeitada', 'sem_topico')) AS mensagens,
      COUNT(*) FILTER (destino = 'rejeitada') AS rejeitadas,
      COUNT(*) FILTER (destino = 'sem_topico') AS sem_topico FROM destinos"""),
    "series_with_rejects": _query([*EVENTS, """textos AS (
  SELECT *, serie_nome = 'Taxa_Financiamento_Imob' AS quebrada FROM pontos)"""], """SELECT kafka_offset,
      CASE WHEN quebrada OR valor IS NULL THEN 'rejeitada' ELSE 'aceita' END AS destino,
      CASE WHEN quebrada THEN 'json' WHEN valor IS NULL THEN 'valor' END AS motivo,
      CASE WHEN NOT quebrada THEN serie_nome END AS serie_nome,
      CASE WHEN NOT quebrada THEN valor END AS valor, CASE WHEN NOT quebrada THEN ano END AS ano
      FROM textos"""),
    "ingest_series_stream": _query(STREAMED, f"SELECT 'bcb' AS {BRONZE} FROM lidos"),
    "ingest_places_stream": _query(PLACES, f"""SELECT fonte, codigo_ibge, nome, uf, regiao, microrregiao,
      mesorregiao, populacao, {SIZE} AS porte_municipio FROM registros"""),
    "both_streams": _query([*STREAMED, *PLACES], """SELECT 'bcb' AS fonte, COUNT(*) AS linhas FROM lidos
      UNION ALL SELECT fonte, COUNT(*) FROM registros GROUP BY fonte"""),
    "stream_resume": _query(STREAMED, """SELECT serie_nome, ano, COUNT(*) AS linhas,
      COUNT(DISTINCT kafka_offset) AS mensagens, MAX(kafka_offset) AS ultima
      FROM lidos GROUP BY serie_nome, ano"""),
    "bronze_series": _query(EVENTS, f"""SELECT 'bcb' AS {BRONZE.replace('unidade',
      "CASE WHEN data_ref >= DATE '2024-01-11' THEN unidade END AS unidade")} FROM pontos"""),
    "bronze_places": _query(PLACES, f"""SELECT fonte, codigo_ibge, nome, uf, regiao, microrregiao,
      mesorregiao, populacao, CASE WHEN fonte = 'ibge_populacao' THEN {SIZE} END AS porte_municipio
      FROM registros"""),
    "silver_indicators": _query(MONTHLY_SILVER, "SELECT * FROM indicadores"),
    "silver_event_points": _query(EVENT_SILVER, "SELECT * FROM indicadores"),
    "silver_part_points": _query(PART_SILVER, "SELECT * FROM indicadores"),
    "previous_value": _history("valor, valor_anterior"),
    "ytd_running_sum": _history("ano, ROUND(soma_ano, 4) AS soma_ano"),
    "abs_change": _history(f"{ABS_CHANGE} AS variacao_absoluta"),
    "pct_change": _history(f"{PCT_CHANGE} AS variacao_pct"),
    "trend_3": _history(f"{TREND} AS tendencia_3m"),
    "above_target_flag": _history(f"{ABOVE} AS acima_meta_inflacao"),
    "classify_series": _count_by(EVENTS, "pontos", "serie_nome", "categoria", alias="pontos"),
    "latest_per_key": _query(MONTHLY_SILVER, """SELECT DISTINCT ON (serie_nome) * FROM indicadores
      ORDER BY serie_nome, data_ref DESC"""),
    "dedupe_latest": _query(EVENTS, """SELECT DISTINCT ON (serie_nome, data_ref) serie_codigo, serie_nome,
      unidade, data_ref, valor, kafka_timestamp, kafka_offset, ano, mes FROM pontos
      ORDER BY serie_nome, data_ref, kafka_timestamp DESC, kafka_offset DESC"""),
    "annual_summary": _query(MONTHLY_SILVER, ANNUAL),
    "interpretation": _query(
        [*MONTHLY_SILVER, "meses AS (SELECT *, valor AS ultimo_valor FROM indicadores)"],
        f"SELECT serie_nome, data_ref, {READING} AS interpretacao_mercado FROM meses"),
    "merge_kinds": _query(PLACES, "SELECT * FROM registros"),
    "split_by_kind": _query(PLACES, """SELECT fonte, codigo_ibge, uf, populacao FROM registros
      WHERE (fonte = 'ibge' AND uf IS NOT NULL) OR (fonte = 'ibge_populacao' AND populacao IS NOT NULL)"""),
    "silver_places": _query(PLACES_MODEL, "SELECT * FROM lugares"),
    "size_bucket": _count_by(PLACES_MODEL, "lugares", "porte_municipio"),
    "relevance_score": _count_by(PLACES_MODEL, "lugares", "score_relevancia"),
    "market_profile": _count_by(PLACES_MODEL, "lugares", "regiao", "perfil_mercado"),
    "percentile_by_value": _query(RANKING, "SELECT codigo_ibge, ROUND(p * 100, 4) AS percentil FROM percentis"),
    "percentile_by_score": _query(RANKING, "SELECT codigo_ibge, ROUND(q * 100, 4) AS percentil FROM percentis"),
    "percentile_of_events": """SELECT event_id,
      ROUND(PERCENT_RANK() OVER (ORDER BY value) * 100, 4) AS percentil FROM events""",
    "overall_rank": _query(RANKING, "SELECT codigo_ibge, ranking_geral FROM ranking"),
    "rank_in_group": _query(RANKING, "SELECT codigo_ibge, regiao, ranking_na_regiao FROM ranking"),
    "rank_events_in_group": """SELECT event_id, event_type, value,
      ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS posicao FROM events""",
    "composite_score": _query(RANKING, "SELECT codigo_ibge, percentil_populacao, score_atratividade FROM ranking"),
    "gold_ranking": _query(RANKING, "SELECT * FROM ranking ORDER BY score_atratividade DESC, ranking_geral"),
    "list_indicators": LISTED,
    "market_panorama": LISTED,
    "series_history": _query(MONTHLY_SILVER, f"""SELECT {POINT} FROM indicadores
      WHERE upper(serie_nome) = 'IPCA' AND ano >= 1997 AND ano <= 1999 ORDER BY data_ref"""),
    "latest_value": _query(MONTHLY_SILVER, f"""SELECT {POINT} FROM indicadores
      WHERE upper(serie_nome) = 'SELIC' ORDER BY data_ref DESC LIMIT 1"""),
    "place_ranking": _query(RANKING, """SELECT codigo_ibge, nome, uf, regiao, populacao, porte_municipio,
      perfil_mercado, score_atratividade, ranking_geral, ranking_na_regiao FROM ranking
      WHERE upper(regiao) = 'SUDESTE' ORDER BY ranking_geral LIMIT 50"""),
    "list_anomalies": _query(FLAGGED_MONTHS, """SELECT serie_nome, data_ref, valor, variacao_pct,
      anomalia_score, anomalia_score_norm, severidade FROM resultados
      WHERE anomalia AND upper(serie_nome) = 'IGP-M' AND severidade = 'alta'
      ORDER BY anomalia_score, serie_nome, data_ref LIMIT 20"""),
    "anomaly_summary": _query(FLAGGED_EVENTS, """SELECT serie_nome, COUNT(*) AS total,
      CAST(SUM(CAST(anomalia AS INT)) AS BIGINT) AS anomalias,
      ROUND(SUM(CAST(anomalia AS INT)) * 100.0 / COUNT(*), 2) AS pct_anomalias
      FROM resultados GROUP BY serie_nome"""),
    "min_history": _query([*PART_SILVER, LONG_ENOUGH], """SELECT serie_nome, serie_codigo, categoria,
      data_ref, ano, mes, valor, acumulado_ano, variacao_pct, variacao_absoluta, tendencia_3m FROM longos"""),
    "zscore": _zscores(),
    "minmax_100": _query(FLAGGED_EVENTS, "SELECT kafka_offset, anomalia_score_norm FROM resultados"),
    "contamination_threshold": _query(FLAGGED_EVENTS, "SELECT kafka_offset, serie_nome, anomalia FROM resultados"),
    "severity_bucket": _query(FLAGGED_EVENTS, "SELECT kafka_offset, severidade FROM resultados"),
    "isolation_forest": _forest(MONTHLY_SILVER),
    "isolation_forest_parts": _forest(PART_SILVER),
    "score_new_points": f"SELECT serie_nome, data_ref, anomalia_score FROM ({_forest(MONTHLY_SILVER)})",
    "anomaly_report": _query([*FLAGGED_MONTHS, TOPS], """SELECT serie_nome, total, anomalias, pct,
      COALESCE(topo, '') AS topo FROM (
        SELECT serie_nome, COUNT(*) AS total, CAST(SUM(CAST(anomalia AS INT)) AS BIGINT) AS anomalias,
          round_even(SUM(CAST(anomalia AS INT)) / COUNT(*)::DOUBLE * 100, 2) AS pct
        FROM resultados GROUP BY serie_nome)
      LEFT JOIN (SELECT serie_nome, string_agg(strftime(data_ref, '%Y-%m-%d') || ' ' || severidade, ', '
        ORDER BY posicao) AS topo FROM tops GROUP BY serie_nome) USING (serie_nome)"""),
    "distinct_series": _query(PARTS, "SELECT DISTINCT serie_nome FROM pontos"),
    "top_anomalies": _query([*FLAGGED_MONTHS, TOPS], "SELECT * FROM tops"),
    "report_totals": _query(FLAGGED_EVENTS, """SELECT COUNT(*) AS total_registros,
      CAST(SUM(CAST(anomalia AS INT)) AS BIGINT) AS total_anomalias,
      round_even(SUM(CAST(anomalia AS INT)) / COUNT(*)::DOUBLE * 100, 2) AS pct_anomalias FROM resultados"""),
    "anomaly_job": _forest(MONTHLY_SILVER),
    "persist_model": _query([*MONTHLY_SILVER, LONG_ENOUGH], f"""SELECT serie_nome,
      CAST({TREES} AS BIGINT) AS arvores, CAST(LEAST(COUNT(*), 256) AS BIGINT) AS amostra
      FROM longos GROUP BY serie_nome"""),
    "publish_table": _query(MONTHLY_SILVER, "SELECT * FROM indicadores"),
    "publish_versions": _query(FLAGGED_MONTHS, """SELECT momento, serie_nome, COUNT(*) AS pontos,
      COUNT(*) AS total FROM resultados CROSS JOIN (VALUES ('aberta'), ('falha'), ('nova')) AS m(momento)
      WHERE momento <> 'nova' OR mes <= 6 GROUP BY momento, serie_nome"""),
    "publish_view": _query(EVENTS, "SELECT kafka_offset, serie_nome, valor FROM pontos"),
    "stamp_processed": _query(PLACES, """SELECT codigo_ibge, '2001-08-31 00:00:00' AS processado_em
      FROM geografico"""),
    "latest_event_values": _query(EVENT_HISTORY, f"""SELECT serie_nome, serie_codigo, categoria, unidade,
      data_ref AS ultima_data, ROUND(valor, 4) AS ultimo_valor, ROUND(soma_ano, 4) AS acumulado_ano,
      {TREND} AS tendencia_3m FROM historia QUALIFY kafka_offset = arg_max(kafka_offset,
        (data_ref, kafka_timestamp, kafka_offset)) OVER (PARTITION BY serie_nome)"""),
    "run_streams": _query(STREAMED, "SELECT serie_nome, COUNT(*) AS linhas FROM lidos GROUP BY serie_nome"),
    "dq_not_null": _query(PLACES_MODEL, "SELECT codigo_ibge, uf FROM lugares WHERE populacao IS NULL"),
    "dq_unique": """SELECT CAST(value AS DECIMAL(18,2)) AS valor, COUNT(*) AS ocorrencias FROM events
      GROUP BY 1 HAVING COUNT(*) > 1""",
    "dq_accepted_values": _query(MONTHLY_SILVER, """SELECT tendencia_3m, COUNT(*) AS ocorrencias
      FROM indicadores WHERE tendencia_3m NOT IN ('alta', 'queda') GROUP BY tendencia_3m"""),
    "quality_summary": _checks(),
}
