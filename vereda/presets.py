"""Domain constants. Every function that uses one takes it as a default argument."""

# Series code, name, unit.
SERIES = [
    ("433", "IPCA", "% a.m."),
    ("189", "IGP-M", "% a.m."),
    ("432", "INPC", "% a.m."),
    ("11", "SELIC", "% a.a."),
    ("7478", "Taxa_Financiamento_Imob", "% a.m."),
    ("4390", "Credito_Imobiliario_Total", "R$ milhoes"),
]

# First date requested from the series service.
HISTORY_START = "2015-01-01"

# Place code, name and state.
PLACES = [
    ("3550308", "São Paulo/SP"),
    ("3304557", "Rio de Janeiro/RJ"),
    ("5300108", "Brasília/DF"),
    ("3106200", "Belo Horizonte/MG"),
    ("4106902", "Curitiba/PR"),
    ("4314902", "Porto Alegre/RS"),
    ("2304400", "Fortaleza/CE"),
    ("2927408", "Salvador/BA"),
    ("2611606", "Recife/PE"),
    ("1302603", "Manaus/AM"),
    ("5208707", "Goiânia/GO"),
    ("4205407", "Florianópolis/SC"),
    ("3205309", "Vitória/ES"),
    ("3509502", "Campinas/SP"),
    ("3518800", "Guarulhos/SP"),
    ("3543402", "Ribeirão Preto/SP"),
    ("3548708", "Santo André/SP"),
    ("3529401", "Osasco/SP"),
]

# Census period read from the population payload.
CENSUS_PERIOD = "2022"

# Source to topic.
TOPICS = {
    "bcb": "imoveis.bcb.series",
    "ibge": "imoveis.ibge.municipios",
    "ibge_populacao": "imoveis.ibge.municipios",
}

# Message key candidates, best first, and the last resort.
KEY_FIELDS = ["cidade_id", "codigo_ibge", "serie_codigo"]
DEFAULT_KEY = "default"

# Partition defaults of the raw JSON lines.
DEFAULT_SOURCE = "anuncios"
UNKNOWN_CITY = "desconhecido"

# Series categories.
CATEGORIES = {
    "IPCA": "inflacao",
    "IGP-M": "inflacao",
    "INPC": "inflacao",
    "SELIC": "juros",
}
OTHER_CATEGORY = "credito_imobiliario"

# A place larger than the bound gets the label, first match wins.
SIZE_BOUNDS = [(1_000_000, "metrópole"), (500_000, "grande"), (100_000, "médio")]
SMALLEST_SIZE = "pequeno"

# A place larger than the bound gets the score, first match wins.
SCORE_BOUNDS = [(1_000_000, 5), (500_000, 4), (200_000, 3), (100_000, 2)]
LOWEST_SCORE = 1

# Market profile by region.
PROFILES = {
    "Sudeste": "mercado_maduro",
    "Sul": "mercado_maduro",
    "Centro-Oeste": "mercado_expansao",
}
OTHER_PROFILE = "mercado_emergente"

# Inflation target, in percent a year.
TARGET_SERIES = "IPCA"
TARGET = 4.5

# Ordered reading rules (series, column, comparison, bound, label).
MARKET_RULES = [
    ("SELIC", "ultimo_valor", ">", 10.0, "juros_altos_financiamento_caro"),
    ("SELIC", "ultimo_valor", "<=", 10.0, "juros_moderados_financiamento_acessivel"),
    ("IPCA", "acumulado_ano", ">", 4.5, "inflacao_pressionada_reajuste_aluguel_alto"),
    ("IGP-M", "ultimo_valor", ">", 0.5, "igpm_elevado_impacto_contratos_aluguel"),
]
NEUTRAL = "cenario_neutro"

# Trend labels.
RISING, FALLING, STEADY = "alta", "queda", "estável"

# Share of the two percentiles in the composite score.
VALUE_WEIGHT, SCORE_WEIGHT = 0.6, 0.4

# Anomaly detection.
FEATURES = ["valor", "variacao_pct", "variacao_absoluta", "acumulado_ano"]
MIN_HISTORY = 24
TREES = 100
TOPIC_PARTITIONS = 3
MAX_SAMPLES = 256
CONTAMINATION = 0.05
SEED = 42

# Severity by upper bound of the 0-100 score.
SEVERITIES = [(20.0, "alta"), (40.0, "média"), (100.0, "baixa")]
NORMAL = "normal"

# Page sizes (default, most).
RANK_PAGE = (20, 100)
ANOMALY_PAGE = (50, 200)
