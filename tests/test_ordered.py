"""The chunked path against the plain windows and against pandas."""

import datetime

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from vereda.operators import ordered
from vereda.session import park
from vereda.plans import silver


@pytest.fixture(scope="module")
def points(spark):
    """A third of the rows in one group, a third of them copies of one row."""
    generator = np.random.default_rng(1)
    groups = ["quente"] * 300 + [f"g{i}" for i in generator.integers(0, 40, 600)]
    frame = pd.DataFrame({
        "g": groups, "at": np.arange(900) * 7919 % 900, "y": generator.integers(0, 3, 900),
        "x": generator.integers(-50, 50, 900).astype(float),
    })
    frame.loc[:99, "x"] = 7.0
    return frame


def collected(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("size", [1, 2, 3, 50, 10_000])
def test_windows_match_pandas(spark, points, size):
    df = spark.createDataFrame(points)
    found = ordered.ordered_windows(
        df, ["g"], [F.col("at")], {"p1": ("x", 1), "p2": ("x", 2)}, {"s": ("x", ["y"])}, size
    ).toPandas().sort_values("at").reset_index(drop=True)
    wanted = points.sort_values("at").reset_index(drop=True)
    by_group = wanted.groupby("g")["x"]
    np.testing.assert_array_equal(found["p1"], by_group.shift(1))
    np.testing.assert_array_equal(found["p2"], by_group.shift(2))
    np.testing.assert_array_equal(found["s"], wanted.groupby(["g", "y"])["x"].cumsum())
    assert list(found.columns) == ["g", "at", "y", "x", "p1", "p2", "s"]


def test_null_group_and_null_values(spark):
    df = spark.createDataFrame(
        [(None, 1, 1.0), (None, 2, None), (None, 3, 3.0), ("a", 1, None), ("a", 2, 5.0)],
        "g string, at int, x double")
    plain = ordered.ordered_windows(df, ["g"], [F.col("at")], {"p": ("x", 1)}, {"s": ("x", [])})
    chunked = ordered.ordered_windows(df, ["g"], [F.col("at")], {"p": ("x", 1)}, {"s": ("x", [])}, 1)
    assert collected(plain) == collected(chunked)


@pytest.mark.parametrize("size", [1, 7, 10_000])
def test_row_numbers(spark, points, size):
    df = spark.createDataFrame(points)
    order = [F.col("x").desc(), F.col("at").asc()]
    everything = {r["at"]: r.posicao for r in ordered.row_numbers(df, order).collect()}
    sorted_rows = points.sort_values(["x", "at"], ascending=[False, True])
    assert everything == {at: i for i, at in enumerate(sorted_rows["at"], 1)}
    grouped = ordered.row_numbers(df, order, ["g"], "n", size)
    wanted = sorted_rows.assign(n=sorted_rows.groupby("g").cumcount() + 1)
    assert {r["at"]: r.n for r in grouped.collect()} == dict(zip(wanted["at"], wanted["n"]))


def test_place_rows_spreads_copies(spark):
    df = spark.range(2000).select(F.lit("igual").alias("k")).repartition(4)
    placed = ordered.place_rows(df, [F.col("k")])
    assert sorted(r._row for r in placed.collect()) == list(range(1, 2001))
    assert placed.select("_total").distinct().first()[0] == 2000


@pytest.mark.parametrize("values", [[5.0], [2.0, 2.0, 2.0], [3.0, 1.0, 1.0, 2.0, None]])
def test_percent_ranks(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    known = [(v is None, v) for v in values]
    ranks = [sum(other < one for other in known) for one in known]
    wanted = {i: rank / (len(values) - 1) if len(values) > 1 else 0.0 for i, rank in enumerate(ranks)}
    for ranked in (ordered.percent_ranks(df, "v"), ordered.percent_ranks(df, "v", rows_per_task=1)):
        assert {r.i: r.percentil for r in ranked.collect()} == wanted


def test_percent_ranks_of_many_values(spark):
    df = spark.range(11).withColumn("v", F.col("id"))
    ranked = ordered.percent_ranks(df, "v", rows_per_task=3)
    assert {r.id: r.percentil for r in ranked.collect()} == {i: i / 10 for i in range(11)}


def test_a_chunk_is_a_task(spark):
    """However the chunks hash, no task of the windows gets more than a chunk and its halo."""
    placed = ordered.place_rows(spark.range(1000).withColumn("g", F.lit(1)), [F.col("id")])
    cut = ordered.chunked_windows(placed, ["g"], {"p": ("id", 2)}, rows_per_task=100)
    sizes = cut.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 10 and {r["count"] for r in sizes} == {100}


def test_last_row_of_a_value(spark):
    values = [1, 1, 1, 1, 2, 3, 3, 3, 3, 3, 3, None, None, 4]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v int")
    for size in (1, 2, 3, 5, 100):
        placed = ordered.place_rows(df, [F.col("v").asc_nulls_last()])
        found = ordered.chunked_windows(placed, [], lasts={"u": "v"}, rows_per_task=size).collect()
        assert {(r.v, r.u) for r in found} == {(1, 4), (2, 5), (3, 11), (4, 12), (None, 14)}
        assert len(found) == len(values)


def test_hot_key_join_is_split(spark):
    """With no broadcast possible, the join back to group statistics splits a hot key."""
    settings_ = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    }
    before = {name: spark.conf.get(name) for name in settings_}
    try:
        for name, value in settings_.items():
            spark.conf.set(name, value)
        key = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 5000)
        df = spark.range(200_000).repartition(8).select(key.alias("g"), F.rand(1).alias("x"))
        joined = ordered.group_stats(df, ["g"], n=F.count(F.lit(1)))
        assert len(joined.collect()) == 200_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_group_quantile(spark, points):
    df = spark.createDataFrame(points)
    found = {r.g: r.limite for r in ordered.group_quantile(df, ["g"], "x", 0.05).collect()}
    wanted = points.groupby("g")["x"].quantile(0.05)
    assert found.keys() == set(wanted.index)
    for group, value in wanted.items():
        assert found[group] == pytest.approx(value, abs=1e-12)


def test_quantile_of_ties_nulls_and_a_missed_bracket(spark):
    rows = [("a", 1.0)] * 500 + [("a", 2.0)] * 500 + [(None, 3.0), ("b", None), ("c", 5.0), ("c", 6.0)]
    df = park(spark.createDataFrame(rows, "g string, x double"))
    for share, accuracy in ((0.05, 10_000), (0.5, 10_000), (0.4995, 50), (0.0, 10_000), (1.0, 10_000)):
        found = {r.g: r.limite for r in ordered.group_quantile(df, ["g"], "x", share, accuracy=accuracy).collect()}
        wanted = {"a": np.quantile([1.0] * 500 + [2.0] * 500, share), "c": 5 + share, None: 3.0}
        assert found == pytest.approx(wanted, abs=1e-9)
    brackets = park(ordered.quantile_brackets(df.filter("x IS NOT NULL"), ["g"], "x", 0.05))
    off = brackets.withColumns({"_from": F.lit(7.0), "_to": F.lit(8.0)})
    picked = ordered._select_quantile(df.filter("x IS NOT NULL"), off, ["g"], "x", 0.05).collect()
    assert len(picked) == 3 and all(r._missed for r in picked)


def test_quantile_of_a_long_group_orders_few_rows(spark):
    """Ten million rows of one series: the bracket has less than one row in a thousand."""
    size = 10_000_000
    df = park(spark.range(0, size, 1, 8).select(
        F.lit("s").alias("g"), ((F.col("id") * 7_368_787) % size).cast("double").alias("x")))
    bracket = ordered.quantile_brackets(df, ["g"], "x", 0.05).first()
    assert bracket._to - bracket._from < size / 1000
    assert ordered.group_quantile(df, ["g"], "x", 0.05).first().limite == pytest.approx((size - 1) * 0.05)


def test_empty_input(spark):
    df = spark.createDataFrame([], "g string, at int, x double")
    assert ordered.ordered_windows(df, ["g"], [F.col("at")], {"p": ("x", 1)}).count() == 0
    assert ordered.row_numbers(df, [F.col("at")]).count() == 0


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from("abc"), st.integers(-3, 3)), min_size=1, max_size=40),
       size=st.integers(1, 9))
def test_any_chunk_size(spark, rows, size):
    df = spark.createDataFrame(
        [(g, i, float(v)) for i, (g, v) in enumerate(rows)], "g string, at int, x double")
    arguments = (["g"], [F.col("at")], {"p": ("x", 2)}, {"s": ("x", [])})
    assert collected(ordered.ordered_windows(df, *arguments, size)) == collected(
        ordered.ordered_windows(df, *arguments))


def test_sums_of_decimals_do_not_depend_on_the_cuts(spark):
    """Same bits for any chunk size and layout, and the border value exactly on the border."""
    values = [0.1, 0.7, 1.1, 2.6, -0.3, 0.2, 0.1] * 12
    df = spark.createDataFrame(
        [("IPCA", 2024, datetime.date(2024, 1, 1) + datetime.timedelta(i), v)
         for i, v in enumerate(values)],
        "serie_nome string, ano int, data_ref date, valor double")
    wanted = np.cumsum([round(v * 10) for v in values]) / 10
    for size, files in ((1_000_000, 1), (1_000_000, 7), (5, 3), (16, 2)):
        found = silver.with_history(df.repartition(files), size).orderBy("data_ref").collect()
        assert [row.soma_ano for row in found] == list(wanted)
        assert [row.ordem for row in found] == list(range(1, len(values) + 1))
