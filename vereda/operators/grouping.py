"""Latest row, best rows and summaries per key."""

from pyspark.sql import DataFrame, Window, functions as F


def latest_per_key(df: DataFrame, keys, order) -> DataFrame:
    """The row with the greatest ``order`` columns for each key.

    The first order column alone is aggregated first, which hashes; only the rows that reach
    its maximum go through the wider aggregate, which has to sort. Both keep one row per key
    and task before the shuffle.
    """
    names, (first, *_) = df.columns, order
    reach = df.groupBy(*[F.col(key).alias(f"_by_{key}") for key in keys]).agg(
        F.max(first).alias("_reach")
    )
    newest = F.col(first).eqNullSafe(F.col("_reach"))
    for key in keys:
        newest = newest & F.col(key).eqNullSafe(F.col(f"_by_{key}"))
    row = F.max_by(F.struct(*names), F.struct(*order)).alias("_row")
    best = df.join(reach, newest, "left_semi")
    return best.groupBy(*[F.col(key).alias(f"_by_{key}") for key in keys]).agg(row).select(
        *[F.col("_row")[name].alias(name) for name in names]
    )


def dedupe_latest(df: DataFrame, keys, order) -> DataFrame:
    """Drop re-published copies, keeping the latest. Not part of the default models."""
    return latest_per_key(df, keys, order)


def top_per_group(df: DataFrame, group, order, count) -> DataFrame:
    """The first ``count`` rows of each group; Spark cuts to ``count`` before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") <= count).drop("_place")


def _mean_4(value):
    """Mean of values of four digits, rounded to four, half away from zero.

    The sum is exact, so a half-way mean does not depend on its order. Values that have no
    place in 38 digits, infinities among them, leave the plain mean.
    """
    units = F.round(F.round(value, 4) * F.lit(1e4)).try_cast("decimal(38,0)")
    total, count = F.try_sum(units), F.count(value)
    twice = F.abs(total) * F.lit(2).cast("decimal(1,0)") + count.cast("decimal(20,0)")
    whole = F.floor(F.try_divide(twice, (count * 2).cast("decimal(20,0)"))).cast("double")
    exact = F.when(F.count(units) == count, F.sign(total) * whole / F.lit(1e4))
    return F.coalesce(exact, F.round(F.avg(value), 4))


def annual_summary(indicators: DataFrame) -> DataFrame:
    """Mean, extremes and number of points by series and year."""
    return indicators.groupBy("serie_nome", "ano").agg(
        _mean_4(F.col("valor")).alias("media_anual"),
        F.round(F.max("valor"), 4).alias("maxima_anual"),
        F.round(F.min("valor"), 4).alias("minima_anual"),
        F.count(F.lit(1)).alias("meses_com_dados"),
    )
