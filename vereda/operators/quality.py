"""Column checks. Each returns the rows, or values, that break the rule."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from vereda import presets


def not_null(df: DataFrame, column) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column) -> DataFrame:
    """Values that occur more than once; nulls are not compared."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("ocorrencias")
    )
    return counts.filter(F.col("ocorrencias") > 1)


def accepted_values(df: DataFrame, column, values) -> DataFrame:
    """Values outside the list with their counts; nulls pass."""
    return df.filter(~F.col(column).isin(list(values))).groupBy(column).agg(
        F.count(F.lit(1)).alias("ocorrencias")
    )


TRENDS = [presets.RISING, presets.FALLING, presets.STEADY]
# The declared checks, as (model, column, check) and the values a check accepts.
CHECKS = [
    ("silver_indicators", "serie_nome", "not_null"),
    ("silver_indicators", "data_ref", "not_null"),
    ("silver_indicators", "valor", "not_null"),
    ("silver_indicators", "tendencia_3m", "accepted_values", TRENDS),
    ("silver_places", "codigo_ibge", "not_null"),
    ("silver_places", "codigo_ibge", "unique"),
    ("silver_places", "uf", "not_null"),
    ("gold_panorama", "serie_nome", "not_null"),
    ("gold_panorama", "serie_nome", "unique"),
    ("gold_ranking", "codigo_ibge", "not_null"),
    ("gold_ranking", "codigo_ibge", "unique"),
    ("gold_ranking", "score_atratividade", "not_null"),
]


def run_checks(models, checks=None) -> DataFrame:
    """Number of violations of every declared check, one row each.

    ``models`` maps a model name to its DataFrame. All null and value checks of a model are
    counted in one pass; each uniqueness check groups by its column. An accepted-values check
    brings its list, else it is that of the trends.
    """
    checks = checks or CHECKS
    results = []
    for model in dict.fromkeys(name for name, *_ in checks):
        df, counted = models[model], []
        for _, column, check, *values in [entry for entry in checks if entry[0] == model]:
            if check == "unique":
                broken = unique(df, column).agg(F.count(F.lit(1)).alias("violacoes"))
                results.append(broken.select(
                    F.lit(model).alias("modelo"), F.lit(column).alias("coluna"),
                    F.lit(check).alias("regra"), "violacoes",
                ))
                continue
            value = F.col(column)
            violations = (
                F.count_if(value.isNull()) if check == "not_null"
                else F.count_distinct(F.when(~value.isin(list(values[0] if values else TRENDS)), value))
            )
            counted.append(F.struct(
                F.lit(column).alias("coluna"), F.lit(check).alias("regra"),
                violations.alias("violacoes"),
            ))
        if counted:
            entries = df.agg(F.array(*counted).alias("_regras")).select(F.explode("_regras"))
            results.append(entries.select(F.lit(model).alias("modelo"), "col.*"))
    return reduce(DataFrame.unionByName, results)
