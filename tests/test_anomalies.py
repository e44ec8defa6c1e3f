import datetime
import hashlib
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vereda import presets
from vereda.errors import NotReady
from vereda.operators import forest
from vereda.plans import anomalies, serve
from vereda.session import new_folder, park
from vereda.sinks import files
from vereda.streaming import scoring

DAY = datetime.date(2024, 6, 30)
FEATURES = ["a", "b"]


def indicators(spark, lengths, spike=None, constant=()):
    """Monthly points per series; the spike is (series, position)."""
    generator = np.random.default_rng(3)
    rows = []
    for name, length in lengths.items():
        for i in range(length):
            value = 1.0 if name in constant else 5 + generator.normal()
            if spike == (name, i):
                value = 90.0
            change = 0.0 if name in constant else generator.normal()
            if spike == (name, i):
                change = 1500.0
            rows.append((name, "1", "c", datetime.date(2000 + i // 12, 1 + i % 12, 1), 2000 + i // 12,
                         1 + i % 12, value, 1.0 if name in constant else value * 2, change, change, "alta"))
    return spark.createDataFrame(rows, """serie_nome string, serie_codigo string, categoria string,
        data_ref date, ano int, mes int, valor double, acumulado_ano double, variacao_pct double,
        variacao_absoluta double, tendencia_3m string""")


def test_min_history(spark):
    kept = anomalies.min_history(indicators(spark, {"curta": 23, "longa": 24}))
    assert {r.serie_nome for r in kept.select("serie_nome").distinct().collect()} == {"longa"}
    assert kept.count() == 24


def test_zscore(spark):
    frame = anomalies.zscore(indicators(spark, {"s": 30, "k": 25}, constant=("k",))).toPandas()
    moving = frame[frame.serie_nome == "s"]
    for name in presets.FEATURES:
        wanted = (moving[name] - moving[name].mean()) / moving[name].std(ddof=0)
        np.testing.assert_allclose(moving[f"z_{name}"], wanted, atol=1e-12)
        assert (frame[frame.serie_nome == "k"][f"z_{name}"] == 0).all()


def test_grade(spark):
    rows = [("a", float(-i)) for i in range(100)] + [("k", -1.0)] * 30
    scored = spark.createDataFrame(rows, "serie_nome string, s double")
    frame = anomalies.grade(scored, "s").toPandas()
    graded = frame[frame.serie_nome == "a"].sort_values("s")
    assert list(graded.anomalia) == [True] * 5 + [False] * 95
    assert list(graded.severidade)[:6] == ["alta"] * 5 + ["normal"]
    assert graded.anomalia_score_norm.iloc[0] == 0.0 and graded.anomalia_score_norm.iloc[-1] == 100.0
    equal = frame[frame.serie_nome == "k"]
    assert not equal.anomalia.any() and equal.anomalia_score_norm.isna().all()
    assert set(equal.severidade) == {"normal"}


def test_detects_a_spike_and_repeats(spark):
    points = indicators(spark, {"a": 80, "b": 60, "curta": 10, "k": 30}, ("a", 40), constant=("k",))
    first = anomalies.detect_all(points, DAY).orderBy("serie_nome", "data_ref").toPandas()
    again = anomalies.detect_all(points.repartition(7), DAY).orderBy("serie_nome", "data_ref").toPandas()
    pd.testing.assert_frame_equal(first, again)
    assert list(first.columns) == [*anomalies.RESULT_COLUMNS, "detectado_em"]
    assert set(first.serie_nome) == {"a", "b", "k"}
    assert ((first.anomalia_score >= -1) & (first.anomalia_score < 0)).all()
    a = first[first.serie_nome == "a"].reset_index(drop=True)
    assert a.anomalia_score.idxmin() == 40 and a.severidade[40] == "alta"
    assert a.anomalia.sum() == 4 and first[first.serie_nome == "b"].anomalia.sum() == 3
    assert not first[first.serie_nome == "k"].anomalia.any()


def test_no_series_qualifies(spark):
    assert anomalies.detect_all(indicators(spark, {"a": 5}), DAY).count() == 0


def cloud(spark, rows, group="g"):
    generator = np.random.default_rng(5)
    frame = pd.DataFrame(generator.normal(size=(rows, 2)), columns=FEATURES)
    frame.iloc[0] = [9.0, -9.0]
    frame["g"], frame["k"] = group, [f"{i // 3}" for i in range(rows)]
    return park(spark.createDataFrame(frame))


@pytest.mark.parametrize("rows, trees, most", [(50, 20, 64), (600, 10, 32), (5000, 10, 32)])
def test_samples_and_nodes(spark, rows, trees, most):
    points = cloud(spark, rows).withColumn("_linha", F.monotonically_increasing_id())
    samples = park(forest.draw_samples(points, "g", "k", FEATURES, trees, most))
    sizes = samples.groupBy("arvore").count().toPandas()
    assert set(sizes["arvore"]) == set(range(1, trees + 1))
    assert (sizes["count"] == min(rows, most)).all()
    assert samples.groupBy("arvore", *FEATURES).count().filter("count > 1").isEmpty()

    nodes = forest.grow_forest(samples, "g", FEATURES, min(rows, most)).toPandas()
    limit = math.ceil(math.log2(min(rows, most)))
    for _, tree in nodes.groupby("arvore"):
        size = dict(zip(tree.no, tree.linhas))
        for node in tree.itertuples():
            assert node.nivel <= limit and node.nivel == int(math.log2(node.no))
            if pd.notna(node.variavel):
                assert size[2 * node.no] + size[2 * node.no + 1] == node.linhas
                assert size[2 * node.no] > 0 and size[2 * node.no + 1] > 0
            else:
                assert 2 * node.no not in size and (node.linhas == 1 or node.nivel == limit)
        assert size[1] == min(rows, most)


def test_forest_does_not_depend_on_files(spark):
    points, seen = cloud(spark, 2000), []
    for files in (1, 7):
        stored = park(points.repartition(files, FEATURES[0]))
        nodes = forest.fit_forest(stored, "g", "k", FEATURES, 5, 16)
        seen.append(sorted(map(tuple, nodes.collect()), key=str))
    assert seen[0] == seen[1]


def brute_score(frame, nodes, trees):
    """Scores by walking every tree for every row."""
    def left_over(n):
        if n <= 1:
            return 0.0
        return 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n

    known = {(r.arvore, r.no): r for r in nodes.itertuples()}
    scores = []
    for row in frame[FEATURES].to_numpy():
        total = 0.0
        for tree in range(1, trees + 1):
            at = known[tree, 1]
            while pd.notna(at.variavel):
                at = known[tree, 2 * at.no + int(row[int(at.variavel) - 1] >= at.corte)]
            total += at.nivel + left_over(at.linhas)
        scores.append(-2 ** (-total / trees / left_over(int(nodes.amostra.iloc[0]))))
    return np.array(scores)


@pytest.mark.parametrize("block", [7, 100_000])
def test_scores_match_walking_the_trees(spark, block):
    points = cloud(spark, 300)
    nodes = park(forest.fit_forest(points, "g", "k", FEATURES, 10, 32))
    frame = forest.score_forest(points, nodes, "g", FEATURES, "s", block).toPandas()
    assert len(frame) == 300 and "_bloco" not in frame.columns
    np.testing.assert_allclose(frame.s, brute_score(frame, nodes.toPandas(), 10), rtol=1e-12)
    assert frame.loc[frame.s.idxmin(), "a"] == 9.0


def test_copies_in_a_hot_series(spark):
    """Two thirds of the rows are one point; blocks stay small and all rows come back."""
    points = park(cloud(spark, 1000).unionAll(cloud(spark, 1).drop("x").select("a", "b", "g", "k")
                  .crossJoin(spark.range(2000)).drop("id")))
    nodes = park(forest.fit_forest(points, "g", "k", FEATURES, 5, 16))
    scored = forest.score_forest(points, nodes, "g", FEATURES, "s", 100)
    assert scored.count() == 3000 and scored.filter("s IS NULL").isEmpty()


def test_samples_of_counted_copies(spark):
    """Many copies of one point on one day: no window over the day, and each copy can be drawn."""
    one = spark.range(25_000).select(
        F.lit(1.0).alias("a"), F.lit(2.0).alias("b"), F.lit("g").alias("g"), F.lit("0").alias("k"))
    points = park(one.unionByName(one.limit(5).withColumn("a", F.lit(3.0))))
    drawn = forest.draw_samples(points, "g", "k", FEATURES, 20, 64)
    plan = drawn._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1
    sizes = drawn.groupBy("arvore").count().collect()
    assert len(sizes) == 20 and {r["count"] for r in sizes} == {64}
    rare = park(forest.draw_samples(points, "g", "k", FEATURES, 20, 25_004))
    assert rare.filter("a = 3.0").count() >= 20 * 4 and rare.count() == 20 * 25_004


def test_versioned_job(spark):
    points, root = indicators(spark, {"a": 40, "curta": 10}, ("a", 20)), new_folder(spark, "versoes")
    with pytest.raises(NotReady):
        files.current_version(spark, root)
    assert anomalies.run_versioned(points, root, DAY, trees=10)
    first = files.current_version(spark, root)
    opened = spark.read.parquet(f"{first}/resultados")
    assert not anomalies.run_versioned(points.filter("serie_nome = 'curta'"), root, DAY, trees=10)
    assert files.current_version(spark, root) == first
    assert anomalies.run_versioned(points.filter("ano > 2000"), root, DAY, trees=10)
    second = files.current_version(spark, root)
    assert second != first and opened.count() == 40
    assert spark.read.parquet(f"{second}/resultados").count() == 28
    assert spark.read.json(f"{second}/relatorio/totais").first().total_registros == 28
    scored = scoring.score_points(points, f"{first}/modelos")
    assert scored.filter("_score IS NULL").select("serie_nome").distinct().collect() == [("curta",)]
    again = scored.join(opened, ["serie_nome", "data_ref"]).filter(
        F.bround("_score", 4) != F.col("anomalia_score"))
    assert scored.count() == 50 and again.isEmpty()


def test_report_and_serving(spark, tmp_path):
    points = indicators(spark, {"IPCA": 80, "b": 60}, ("IPCA", 40))
    results = park(anomalies.detect_all(points, DAY, trees=20))
    totals = anomalies.report_totals(results).first()
    assert (totals.total_registros, totals.total_anomalias, totals.pct_anomalias) == (140, 7, 5.0)
    report = anomalies.anomaly_report(results, DAY)
    row = report.first()
    assert set(row.por_serie) == {"IPCA", "b"}
    tops = row.por_serie["IPCA"].top_anomalias
    assert len(tops) == 3 and tops[0].valor == 90.0 and row.por_serie["IPCA"].anomalias == 4
    files.write_report(report, str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).first().total_anomalias == 7

    listed = serve.list_anomalies(results, "ipca").collect()
    assert len(listed) == 4 and listed[0].valor == 90.0
    assert all(r.severidade == "alta" for r in serve.list_anomalies(results, severity="alta").collect())
    assert {r.serie_nome: (r.total, r.anomalias, r.pct_anomalias)
            for r in serve.anomaly_summary(results).collect()} == {"IPCA": (80, 4, 5.0), "b": (60, 3, 5.0)}


def test_stored_forest(spark):
    folder = new_folder(spark, "modelos")
    _, nodes = anomalies.score_series(indicators(spark, {"IGP-M": 30}), trees=3)
    files.persist_forest(nodes, folder)
    stored = spark.read.parquet(folder)
    assert {r.modelo for r in stored.select("modelo").distinct().collect()} == {"igp-m"}
    assert stored.count() == nodes.count()


def many_short(spark, series=40, rows=30):
    return indicators(spark, {f"P{i}": rows for i in range(series)})


def test_short_series_are_not_stored_once_a_tree(spark, monkeypatch):
    stored = []

    def counting(df, label="table"):
        frame = park(df, label)
        stored.append((label, frame.count()))
        return frame

    monkeypatch.setattr(forest, "park", counting)
    monkeypatch.setattr(anomalies, "park", counting)
    scored, nodes = anomalies.score_series(many_short(spark), trees=50)
    assert scored.count() == 1200 and scored.filter("_score IS NULL").isEmpty()
    assert {label for label, _ in stored} >= {"points", "samples", "scored"}
    assert max(rows for _, rows in stored) == 1200, stored
    assert nodes.select("serie_nome", "arvore").distinct().count() == 40 * 50


@pytest.mark.parametrize("block", [50, 100_000])
def test_scores_by_samples_match_scores_by_nodes(spark, block):
    """Short, long and nameless series, and names too long for one block of a digest."""
    points = park(cloud(spark, 20, "short").unionByName(cloud(spark, 31, "short" * 12))
                  .unionByName(cloud(spark, 32, "even")).unionByName(cloud(spark, 500, "long"))
                  .unionByName(cloud(spark, 25, "x").withColumn("g", F.lit(None).cast("string")))
                  .unionByName(cloud(spark, 1, "one")).unionByName(cloud(spark, 2, "two")))
    samples = forest.forest_samples(points, "g", "k", FEATURES, 10, 32)
    nodes = park(forest.grow_forest(samples, "g", FEATURES, 32))
    plain = forest.grow_forest(
        forest.draw_samples(points, "g", "k", FEATURES, 10, 32), "g", FEATURES, 32)
    assert nodes.exceptAll(plain).isEmpty() and nodes.count() == plain.count()
    frames = [
        forest.score_forest(points, given, "g", FEATURES, "s", block).toPandas()
        .sort_values(["g", "a", "b"]).reset_index(drop=True)
        for given in (samples, nodes)
    ]
    pd.testing.assert_frame_equal(*frames)
    frame, grown = frames[0], nodes.toPandas()
    assert len(frame) == 611 and frame.s[frame.g.isna()].isna().all()
    for name, rows in frame[frame.g.notna() & (frame.g != "one")].groupby("g"):
        mine = grown[grown.g == name]
        np.testing.assert_allclose(rows.s, brute_score(rows, mine, 10), rtol=1e-12)


def test_cuts_are_drawn_from_digests():
    generator = np.random.default_rng(7)
    for longest in (10, 70):
        names = [f"42|{'ã' * i}P{i}".encode() for i in range(longest // 2)] + [b"42"]
        of = generator.integers(0, len(names), 3000)
        tree, node = generator.integers(1, 101, 3000), generator.integers(1, 256, 3000)
        drawn = forest._draws(names, of, tree, node)
        for i in range(0, 3000, 7):
            text = names[of[i]].decode() + f"|{tree[i]}|{node[i]}"
            digest = hashlib.md5(text.encode()).hexdigest()
            assert drawn[0, i] == int(digest[:8], 16) / 2**32
            assert drawn[1, i] == int(digest[8:16], 16) / 2**32
