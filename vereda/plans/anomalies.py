"""Anomalies of the indicator series: features, forest, grades and report."""

from pyspark.sql import DataFrame, Window, functions as F

from vereda import presets
from vereda.functions import labels
from vereda.operators.forest import forest_samples, grow_forest, score_forest
from vereda.operators.grouping import top_per_group
from vereda.operators.ordered import group_quantile, group_stats
from vereda.plans.silver import enough_history, stamp
from vereda.session import park
from vereda.sinks import files

SERIES = "serie_nome"

# Columns of the stored results.
RESULT_COLUMNS = [
    "serie_nome", "serie_codigo", "categoria", "data_ref", "ano", "mes", "valor",
    "variacao_pct", "acumulado_ano", "anomalia", "anomalia_score", "anomalia_score_norm",
    "severidade",
]


def distinct_series(points: DataFrame) -> DataFrame:
    return points.select(SERIES).distinct()


def min_history(points: DataFrame, least=presets.MIN_HISTORY) -> DataFrame:
    """Points of series that have at least ``least`` of them. ``points`` has to be stored."""
    counted = group_stats(points, [SERIES], _pontos=F.count(F.lit(1)))
    return counted.filter(F.col("_pontos") >= least).drop("_pontos")


def fill_zero(points: DataFrame, features=presets.FEATURES) -> DataFrame:
    """Features without nulls or NaN, as extra columns."""
    return points.withColumns({
        f"_{name}": F.nanvl(F.coalesce(F.col(name), F.lit(0.0)), F.lit(0.0)) for name in features
    })


def zscore(points: DataFrame, features=presets.FEATURES) -> DataFrame:
    """Features standardised by series as ``z_*``, 0 where a feature is constant.

    ``points`` has to be stored: it is read twice.
    """
    filled = fill_zero(points, features)
    stats = {}
    for name in features:
        stats[f"_mean_{name}"] = F.avg(f"_{name}")
        # A constant feature: its mean and spread are only near the value and near 0.
        constant = F.min(f"_{name}") == F.max(f"_{name}")
        stats[f"_sd_{name}"] = F.when(constant, F.lit(0.0)).otherwise(F.stddev_pop(f"_{name}"))
    measured = group_stats(filled, [SERIES], **stats)
    scaled = {}
    for name in features:
        apart = (F.col(f"_{name}") - F.col(f"_mean_{name}")) / F.col(f"_sd_{name}")
        scaled[f"z_{name}"] = F.when(F.col(f"_sd_{name}") == 0, F.lit(0.0)).otherwise(apart)
    return measured.withColumns(scaled).select(
        *points.columns, *[f"z_{name}" for name in features]
    )


def minmax_100(points: DataFrame, score, column="anomalia_score_norm", source=None) -> DataFrame:
    """Score scaled to 0-100 by series; null where all scores are equal.

    ``source`` is a stored frame with the same scores, where ``points`` is computed.
    """
    measured = group_stats(points, [SERIES], source, _low=F.min(score), _high=F.max(score))
    scaled = F.try_divide(F.col(score) - F.col("_low"), F.col("_high") - F.col("_low"))
    return measured.withColumn(column, F.bround(scaled * F.lit(100.0), 1)).drop("_low", "_high")


def contamination_threshold(points: DataFrame, score, share=presets.CONTAMINATION,
                            column="anomalia") -> DataFrame:
    """Flag scores strictly below the ``share`` quantile of their series.

    ``points`` has to be stored: it is read several times.
    """
    limits = group_quantile(points, [SERIES], score, share, "_limite").select(
        F.col(SERIES).alias("_serie"), "_limite"
    )
    joined = points.join(limits, F.col(SERIES).eqNullSafe(F.col("_serie")), "left")
    flag = F.coalesce(F.col(score) < F.col("_limite"), F.lit(False))
    return joined.withColumn(column, flag).drop("_serie", "_limite")


def grade(scored: DataFrame, score) -> DataFrame:
    """Flag, rounded score, 0-100 score and severity of scored points.

    ``scored`` has to be stored: it is read several times.
    """
    flagged = contamination_threshold(scored, score)
    scaled = minmax_100(flagged, score, source=scored)
    return scaled.withColumns({
        "anomalia_score": F.bround(F.col(score), 4),
        "severidade": labels.severity_bucket(F.col("anomalia_score_norm"), F.col("anomalia")),
    })


def score_series(indicators: DataFrame, trees=presets.TREES, max_samples=presets.MAX_SAMPLES,
                 seed=presets.SEED, least=presets.MIN_HISTORY):
    """Stored points with their isolation score, and the forest, grown from stored samples.

    Cuts are drawn between a feature's smallest and largest value, so scaling a feature does
    not change the forest and the features go in unscaled. The scores' tasks grow the trees they
    need themselves; the nodes are only made for those who read the forest.
    """
    features = [f"_{name}" for name in presets.FEATURES]
    history = park(enough_history(indicators), "history")
    points = park(fill_zero(min_history(history, least)), "points")
    samples = forest_samples(points, SERIES, "data_ref", features, trees, max_samples, seed)
    scored = park(score_forest(points, samples, SERIES, features), "scored")
    forest = grow_forest(samples, SERIES, features, max_samples, seed)
    return scored.drop(*features), forest


def detect_all(indicators: DataFrame, as_of=None, **options) -> DataFrame:
    """Graded points of every series with enough history; no rows if none has."""
    scored, _ = score_series(indicators, **options)
    return grade(scored, "_score").select(
        *RESULT_COLUMNS, stamp(as_of).alias("detectado_em")
    )


def run_job(indicators: DataFrame, table, models_path, report_path, as_of=None, table_path=None,
            **options) -> bool:
    """Detect, then replace the result table, the stored forests and the report.

    If no series has enough history, nothing is written, the old ones stay, and the answer
    is False.
    """
    scored, forest = score_series(indicators, **options)
    results = grade(scored, "_score").select(*RESULT_COLUMNS, stamp(as_of).alias("detectado_em"))
    if not files.replace_results(results, table, table_path):
        return False
    files.persist_forest(forest, models_path)
    write_summary(indicators.sparkSession.table(table), report_path, as_of)
    return True


def run_versioned(indicators: DataFrame, root, as_of=None, **options) -> bool:
    """Detect, then publish results, forests and report as one version below ``root``.

    Readers of ``files.current_version`` have all three of one run, also while a run writes or
    after one that failed. False, and nothing published, if no series has enough history.
    """
    scored, forest = score_series(indicators, **options)
    results = park(grade(scored, "_score").select(
        *RESULT_COLUMNS, stamp(as_of).alias("detectado_em")
    ), "resultados")
    if results.isEmpty():
        return False

    def write(folder):
        results.write.parquet(f"{folder}/resultados")
        files.persist_forest(forest, f"{folder}/modelos")
        write_summary(results, f"{folder}/relatorio", as_of)

    files.publish_version(indicators.sparkSession, root, write)
    return True


def write_summary(anomalies: DataFrame, path, as_of=None) -> None:
    """The report as JSON: totals below ``totais``, one object per series below ``por_serie``."""
    totals = report_totals(anomalies).withColumn("gerado_em", stamp(as_of))
    files.write_report(totals, f"{path}/totais")
    files.write_report(report_by_series(anomalies), f"{path}/por_serie")


def top_anomalies(anomalies: DataFrame, count=3) -> DataFrame:
    """The oddest anomalous points of each series, numbered from 1."""
    order = [F.col("anomalia_score"), F.col("data_ref"), F.col("valor")]
    best = top_per_group(anomalies.filter(F.col("anomalia")), [SERIES], order, count)
    place = F.row_number().over(Window.partitionBy(SERIES).orderBy(*order))
    return best.withColumn("posicao", place).select(
        SERIES, "posicao", "data_ref", "valor", "variacao_pct", "severidade", "anomalia_score"
    )


def report_totals(anomalies: DataFrame) -> DataFrame:
    """Points, anomalies and their share over everything."""
    total, flagged = F.count(F.lit(1)), F.coalesce(F.sum(F.col("anomalia").cast("int")), F.lit(0))
    return anomalies.agg(
        total.alias("total_registros"),
        flagged.alias("total_anomalias"),
        F.bround(F.try_divide(flagged.cast("double"), total.cast("double")) * 100.0, 2).alias(
            "pct_anomalias"
        ),
    )


def report_by_series(anomalies: DataFrame) -> DataFrame:
    """Points, anomalies, share and the three oddest points of each series."""
    total, flagged = F.count(F.lit(1)), F.sum(F.col("anomalia").cast("int"))
    counts = anomalies.groupBy(SERIES).agg(
        total.alias("total"), flagged.alias("anomalias"),
        F.bround(flagged.cast("double") / total * 100.0, 2).alias("pct"),
    )
    entry = F.struct("posicao", "data_ref", "valor", "variacao_pct", "severidade")
    tops = top_anomalies(anomalies).groupBy(SERIES).agg(
        F.sort_array(F.collect_list(entry)).alias("_tops")
    )
    shown = F.transform("_tops", lambda top: F.struct(
        top["data_ref"].alias("data_ref"), top["valor"].alias("valor"),
        top["variacao_pct"].alias("variacao_pct"), top["severidade"].alias("severidade"),
    ))
    empty = F.array().cast(
        "array<struct<data_ref:date,valor:double,variacao_pct:double,severidade:string>>"
    )
    return counts.join(tops, SERIES, "left").select(
        SERIES, "total", "anomalias", "pct", F.coalesce(shown, empty).alias("top_anomalias")
    )


def anomaly_report(anomalies: DataFrame, as_of=None) -> DataFrame:
    """The summary as one document, for a few series; ``write_summary`` is for any number."""
    entry = F.struct("total", "anomalias", "pct", "top_anomalias")
    by_series = report_by_series(anomalies).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(SERIES, entry.alias("resumo")))))
        .alias("por_serie"),
        F.lit(1).alias("_um"),
    )
    totals = report_totals(anomalies).withColumn("_um", F.lit(1))
    return totals.join(by_series, "_um").select(
        stamp(as_of).alias("gerado_em"), "total_registros", "total_anomalias", "pct_anomalias",
        "por_serie",
    )
