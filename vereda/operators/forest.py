"""Isolation forest per group (Liu, Ting and Zhou, ICDM 2008) over any number of rows.

Fitting reads a bounded sample per tree; a group no longer than a sample is all of it in every
tree, and is stored once and not once a tree. Groups are dealt into lots, and a task grows all
trees of the groups of a lot at once, level by level. Scoring splits a group's rows into blocks
of bounded size, so a hot group is many tasks, and sends the group's forest, which is bounded
too, to each block: as its nodes, or as the samples, from which the task grows the same trees.
Short groups have far more nodes than rows, so their samples are much less to move.
"""

import functools
import math
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from vereda import presets
from vereda.operators.ordered import group_stats
from vereda.session import park

BLOCK_ROWS = 100_000
POINTS_PER_LOT = 12_500
SAMPLED, STORED = 400, 32  # blocks in a lot whose forests come as samples, or as nodes
LOTS_PER_TASK = 4
CELLS_PER_TASK = 2_000_000  # rows times trees to grow
CELLS = 1 << 16  # rows times trees that are held at a time
COPIES = 10_000

EULER = 0.5772156649015329
_ID = "_linha"

_DIGEST_PIECE = 1 << 13
_TURNS = [7, 12, 17, 22] * 4 + [5, 9, 14, 20] * 4 + [4, 11, 16, 23] * 4 + [6, 10, 15, 21] * 4
_ADDED = [np.uint32(int(abs(math.sin(i + 1)) * 2**32)) for i in range(64)]
_INITIAL = [np.uint32(word) for word in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]


def unsuccessful_search(size: np.ndarray) -> np.ndarray:
    """Mean path length that ``size`` rows left in a leaf would still have."""
    n = np.maximum(size, 2).astype(float)
    more = 2.0 * (np.log(n - 1) + EULER) - 2.0 * (n - 1) / n
    return np.where(size <= 1, 0.0, np.where(size == 2, 1.0, more))


def draw_samples(points: DataFrame, group, key, features, trees=presets.TREES,
                 max_samples=presets.MAX_SAMPLES, seed=presets.SEED) -> DataFrame:
    """``min(max_samples, rows)`` rows without replacement for each tree of each group.

    Every row draws a hash for every tree, and a tree takes the rows with the smallest. Only
    draws that can be among them become rows: at first enough for twelve deviations more than
    wanted, so a group yields a bounded number of rows however long it is. Hashes are of the
    row's content and a number for copies, so the file layout does not matter. Copies are
    counted in the tasks and numbered from their count, in blocks of ``COPIES`` that are dealt
    out, so neither a day of many rows nor a point of many copies is one task. ``points`` has
    to be a stored table.
    """
    counted = points.groupBy(group, key, *features).agg(F.count(F.lit(1)).alias("_copias"))
    blocks = counted.withColumn(
        "_bloco", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(_copias - 1) div {COPIES}")))
    ).repartition(group, key, *features, "_bloco")
    sizes = points.groupBy(F.col(group).alias("_de")).agg(F.count(F.lit(1)).alias("_n"))
    first = F.col("_bloco") * COPIES + 1
    copies = F.sequence(first, F.least(F.col("_copias"), first + (COPIES - 1)))
    share = (F.col("_psi") + F.lit(12.0) * F.sqrt("_psi") + F.lit(40.0)) / F.col("_n")

    def draw(tree):
        return F.xxhash64("_marca", "_copia", tree).bitwiseAND(F.lit((1 << 63) - 1))

    able = F.filter(
        F.sequence(F.lit(1), F.lit(trees)),
        lambda tree: draw(tree).cast("double") <= F.col("_share") * F.lit(float(1 << 63)),
    )
    by_tree = Window.partitionBy(group, "arvore").orderBy("_ordem", key, *features, "_copia")
    return (
        blocks.join(sizes, F.col(group).eqNullSafe(F.col("_de")))
        .withColumn("_psi", F.least("_n", F.lit(max_samples)))
        .withColumn("_share", F.least(share, F.lit(1.0)))
        .withColumn("_marca", F.xxhash64(F.lit(seed), group, key, *features))
        .withColumn("_copia", F.explode(copies))
        .withColumn("arvore", F.explode(able))
        .withColumn("_ordem", draw(F.col("arvore")))
        .withColumn("_vez", F.row_number().over(by_tree))
        .filter(F.col("_vez") <= max_samples)
        .select(group, "arvore", "_psi", *features)
    )


def check_samples(samples: DataFrame, group) -> None:
    """Raise if a tree has fewer rows than it is to have, which needs a broken hash."""
    short = samples.groupBy(group, "arvore").agg(
        F.count(F.lit(1)).alias("_got"), F.max("_psi").alias("_wanted")
    ).filter("_got < _wanted")
    if not short.isEmpty():
        raise RuntimeError("a tree drew too few rows")


def forest_samples(points: DataFrame, group, key, features, trees=presets.TREES,
                   max_samples=presets.MAX_SAMPLES, seed=presets.SEED) -> DataFrame:
    """Stored samples of every tree of each group of a stored points table.

    A group of at most ``max_samples`` rows is stored once, without an ``arvore``, and stands
    for ``_arvores`` trees. ``_nome`` begins what the cuts of the group are drawn from.
    """
    sizes = points.groupBy(F.col(group).alias("_de")).agg(F.count(F.lit(1)).alias("_n"))
    same = F.col(group).eqNullSafe(F.col("_de"))
    samples = points.join(sizes.filter(F.col("_n") <= max_samples), same).select(
        group, F.lit(None).cast("int").alias("arvore"), F.col("_n").alias("_psi"), *features
    )
    if largest_group(points, [group]) > max_samples:
        long = points.join(sizes.filter(F.col("_n") > max_samples), same, "left_semi")
        samples = samples.unionByName(
            draw_samples(long, group, key, features, trees, max_samples, seed)
        )
    stored = park(_prepared(samples, group, trees, seed), "samples")
    check_samples(stored, group)
    return stored


def _prepared(samples, group, trees, seed):
    """Samples with the names their cuts are drawn from and the depth of their trees."""
    return samples.withColumns({
        "_arvores": F.lit(trees),
        "_limite": F.ceil(F.log2(F.greatest("_psi", F.lit(2)).cast("double"))),
        "_nome": F.concat_ws("|", F.lit(str(seed)), F.col(group).cast("string")),
    })


@functools.lru_cache(maxsize=32)
def _endings(trees, heap):
    """What follows a group's name in a digest, for every tree and node, padded; and its length."""
    texts = [b"|%d|%d\x80" % (tree, node) for tree in range(trees + 1) for node in range(heap)]
    table = np.array(texts)
    return table.view(np.uint8).reshape(len(texts), -1), np.array([len(x) - 1 for x in texts])


def _first_words(blocks):
    """The first eight bytes of the MD5 of one-block messages, as two big-endian numbers each."""
    words = np.ascontiguousarray(blocks.view("<u4").T)
    a, b, c, d = (np.full(len(blocks), word) for word in _INITIAL)
    for i, (turn, added) in enumerate(zip(_TURNS, _ADDED)):
        if i < 16:
            mixed, k = d ^ (b & (c ^ d)), i
        elif i < 32:
            mixed, k = c ^ (d & (b ^ c)), (5 * i + 1) % 16
        elif i < 48:
            mixed, k = b ^ c ^ d, (3 * i + 5) % 16
        else:
            mixed, k = c ^ (b | ~d), 7 * i % 16
        mixed += a
        mixed += words[k]
        mixed += added
        turned = mixed << np.uint32(turn)
        turned |= mixed >> np.uint32(32 - turn)
        turned += b
        a, b, c, d = d, turned, b, c
    return (a + _INITIAL[0]).byteswap(), (b + _INITIAL[1]).byteswap()


def _draws(names, of, tree, node):
    """Two numbers in [0, 1) for each node, from the MD5 of its group's name, tree and number."""
    lengths = np.array([len(name) for name in names])[of]
    trees, heap = int(tree.max()), 1 << int(node.max()).bit_length()
    small = (trees + 1) * heap <= 1 << 17
    if not small or lengths.max() + len(b"|%d|%d" % (trees, heap)) > 55:
        told = (
            md5(b"%b|%d|%d" % (names[g], t, k)).digest()[:8]
            for g, t, k in zip(of.tolist(), tree.tolist(), node.tolist())
        )
        return np.frombuffer(b"".join(told), ">u4").reshape(-1, 2).T / 4294967296.0
    endings, sizes = _endings(trees, heap)
    starts = np.array(names).view(np.uint8).reshape(len(names), -1)
    code = tree * heap + node
    drawn = np.empty((2, len(of)))
    for at in range(0, len(of), _DIGEST_PIECE):
        piece = slice(at, at + _DIGEST_PIECE)
        ending, length = code[piece], lengths[piece]
        blocks = np.zeros((len(ending), 64), np.uint8)
        blocks[:, :starts.shape[1]] = starts[of[piece]]
        for size in np.unique(length):
            mine = np.flatnonzero(length == size)
            blocks[mine, size:size + endings.shape[1]] = endings[ending[mine]]
        blocks.view("<u4")[:, 14] = (length + sizes[ending]) * 8
        drawn[:, piece] = _first_words(blocks)
    return drawn / 4294967296.0


def _runs(first, size):
    """Row numbers of runs of ``size`` rows from ``first``, one run after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + size, size)


def _grow(names, limit, group, tree, first, size, values):
    """Nodes of trees by level: (group, tree, node, rows, level, feature, cut, left child).

    A tree has the ``size`` columns of ``values`` from ``first`` on. Features count from 0; a
    leaf has the cut NaN and is its own left child, and a right child follows the left one.
    """
    node, row = np.ones(len(tree), np.int64), _runs(first, size)
    width, done, levels = values.shape[1], 0, []
    while len(size):
        start, level = np.cumsum(size) - size, len(levels)
        seen = values[:, row]
        low = np.minimum.reduceat(seen, start, axis=1)
        high = np.maximum.reduceat(seen, start, axis=1)
        varying = np.cumsum(high > low, axis=0)  # how many of the features so far vary
        split = (size > 1) & (level < limit[group]) & (varying[-1] > 0)
        feature, cut = np.zeros(len(size), np.int64), np.full(len(size), np.nan)
        left = done + np.arange(len(size))
        done += len(size)
        levels.append((group, tree, node, size, np.full(len(size), level), feature, cut, left))
        if not split.any():
            break
        row = row[np.repeat(split, size)]
        group, tree, node, size = group[split], tree[split], node[split], size[split]
        which, share = _draws(names, group, tree, node)
        varying = varying[:, split]
        # A digest picks one of the features that vary, another part of it the cut.
        picked = np.argmax(varying == np.floor(which * varying[-1]) + 1, axis=0)
        at = np.arange(len(size))
        lowest, highest = low[:, split][picked, at], high[:, split][picked, at]
        between = lowest + share * (highest - lowest)
        between = np.where((between > lowest) & (between <= highest), between, highest)
        feature[split], cut[split], left[split] = picked, between, done + 2 * at

        right = values.ravel()[np.repeat(picked * width, size) + row] >= np.repeat(between, size)
        start = np.cumsum(size) - size
        so_far = np.cumsum(right)
        so_far -= np.repeat(so_far[start] - right[start], size)
        greater = so_far[start + size - 1]
        smaller = size - greater
        place = np.where(
            right, np.repeat(start + smaller - 1, size) + so_far, np.arange(len(row)) - so_far
        )
        moved = np.empty_like(row)
        moved[place] = row
        row = moved
        size = np.stack((smaller, greater), 1).ravel()
        node = np.stack((2 * node, 2 * node + 1), 1).ravel()
        group, tree = np.repeat(group, 2), np.repeat(tree, 2)
    return [np.concatenate(part) for part in zip(*levels)]


def _grown(samples: pa.Table, code: np.ndarray, features):
    """Trees of the groups of a lot, some groups at a time: (codes, psi, names, nodes).

    ``code`` numbers the groups; nodes have them by their place in the codes.
    """
    tree = samples["arvore"].fill_null(0).to_numpy()
    order = np.lexsort((tree, code))
    tree, code = tree[order].astype(np.int64), code[order]
    values = np.stack([samples[name].to_numpy()[order].astype(float) for name in features])
    begins = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    rows = np.diff(np.r_[begins, len(code)])
    trees = samples["_arvores"].to_numpy()[order[begins]]
    cells = np.cumsum(rows * np.where(tree[begins] == 0, trees, 1))
    for some in np.split(np.arange(len(begins)), np.flatnonzero(np.diff(cells // CELLS)) + 1):
        a, b = begins[some[0]], begins[some[-1]] + rows[some[-1]]
        run = np.flatnonzero(np.r_[True, (np.diff(code[a:b]) != 0) | (np.diff(tree[a:b]) != 0)])
        size, of = np.diff(np.r_[run, b - a]), np.searchsorted(code[begins[some]], code[a:b][run])
        # A run without a tree is the sample of every tree of its group.
        times = np.where(tree[a:b][run] == 0, trees[some][of], 1)
        every = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + 1
        taken = pa.array(order[begins[some]])
        table = samples.select(["_psi", "_limite", "_nome"]).take(taken)
        names = [name.encode() for name in table["_nome"].to_pylist()]
        number = np.where(np.repeat(tree[a:b][run], times) == 0, every, np.repeat(tree[a:b][run], times))
        nodes = _grow(
            names, table["_limite"].to_numpy(), np.repeat(of, times), number,
            np.repeat(run, times), np.repeat(size, times), np.ascontiguousarray(values[:, a:b]),
        )
        yield code[begins[some]], table["_psi"].to_numpy(), taken, nodes


def _codes(group, *tables):
    """The same number for the same group, and block of it, in all tables."""
    names = pa.chunked_array(
        [chunk for table in tables for chunk in table[group].chunks], tables[0][group].type
    )
    encoded = names.combine_chunks().dictionary_encode(null_encoding="encode")
    code = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    if "_bloco" in tables[0].column_names:
        block = np.concatenate([table["_bloco"].to_numpy() for table in tables])
        code = code * (block.max(initial=0) + 1) + block
    return np.split(code, np.cumsum([table.num_rows for table in tables])[:-1])


def _grow_lot(group, features, columns):
    """The nodes of all groups of a lot as a table."""

    def run(samples: pa.Table) -> pa.Table:
        code, = _codes(group, samples)
        parts = []
        for _, psi, taken, (of, tree, node, size, level, feature, cut, _) in _grown(
            samples, code, features
        ):
            leaf = np.isnan(cut)
            parts.append(pa.table([
                samples[group].take(taken).take(pa.array(of)), pa.array(tree, pa.int32()),
                pa.array(node), pa.array(feature + 1, pa.int32(), mask=leaf),
                pa.array(cut, pa.float64(), mask=leaf), pa.array(size),
                pa.array(level, pa.int32()), pa.array(psi[of], pa.int32()),
            ], names=columns))
        return pa.concat_tables(parts)

    return run


def grow_forest(samples: DataFrame, group, features, max_samples=presets.MAX_SAMPLES,
                seed=presets.SEED, tasks=None) -> DataFrame:
    """Nodes of all trees: (group, arvore, no, variavel, corte, linhas, nivel, amostra).

    ``no`` is 1 for the root and 2k, 2k + 1 below node k; a leaf has no ``variavel``.
    ``max_samples`` is the size of the largest sample. The number of ``tasks`` is fixed,
    because levels cost time, not bytes, and would be merged into too few tasks.
    """
    spark = samples.sparkSession
    if "_nome" not in samples.columns:
        samples = _prepared(samples, group, 0, seed)
    depth = math.ceil(math.log2(max(max_samples, 2)))
    samples = samples.withColumn("_limite", F.least("_limite", F.lit(depth).cast("bigint")))
    if not tasks:
        cells = samples.agg(
            F.sum(F.when(F.col("arvore").isNull(), F.col("_arvores")).otherwise(1))
        ).first()[0] or 0
        tasks = max(spark.sparkContext.defaultParallelism, math.ceil(cells / CELLS_PER_TASK))
    schema = StructType([
        samples.schema[group], StructField("arvore", IntegerType()),
        StructField("no", LongType()), StructField("variavel", IntegerType()),
        StructField("corte", DoubleType()), StructField("linhas", LongType()),
        StructField("nivel", IntegerType()), StructField("amostra", IntegerType()),
    ])
    lot = F.pmod(F.xxhash64(group), F.lit(tasks * LOTS_PER_TASK))
    return (
        samples.withColumn("_lote", lot)
        .repartition(tasks, "_lote")
        .groupBy("_lote")
        .applyInArrow(_grow_lot(group, features, schema.fieldNames()), schema)
    )


def largest_group(df: DataFrame, keys) -> int:
    """Rows in the largest group."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.agg(F.max("_rows")).first()[0] or 0


def fit_forest(points: DataFrame, group, key, features, trees=presets.TREES,
               max_samples=presets.MAX_SAMPLES, seed=presets.SEED) -> DataFrame:
    """Forest nodes of every group of a stored points table."""
    samples = forest_samples(points, group, key, features, trees, max_samples, seed)
    return grow_forest(samples, group, features, max_samples, seed)


def _stored(nodes: pa.Table, code: np.ndarray):
    """The nodes of a lot as ``_grown`` gives them, all groups at a time."""
    tree, node = nodes["arvore"].to_numpy(), nodes["no"].to_numpy()
    level = nodes["nivel"].to_numpy()
    order = np.lexsort((node, tree, code, level))
    level, code = level[order], code[order]
    feature = nodes["variavel"].fill_null(0).to_numpy()[order].astype(np.int64) - 1
    leaf = feature < 0
    cut = np.where(leaf, np.nan, nodes["corte"].fill_null(0.0).to_numpy()[order])
    left = np.arange(len(code))
    roots = int((level == 0).sum())
    # By level, the children of the inner nodes follow the roots in their parents' order.
    left[~leaf] = roots + 2 * np.arange(len(code) - int(leaf.sum()))
    groups, first = np.unique(code[:roots], return_index=True)
    psi = nodes["amostra"].to_numpy()[order][first]
    yield groups, psi, None, (
        np.searchsorted(groups, code), tree[order], node[order],
        nodes["linhas"].to_numpy()[order], level, np.maximum(feature, 0), cut, left,
    )


def _score_lot(group, features, score, sampled):
    """Score the rows of the blocks of a lot with the trees of their groups."""

    def run(points: pa.Table, sent: pa.Table) -> pa.Table:
        scores, known = np.full(points.num_rows, np.nan), np.zeros(points.num_rows, bool)
        if points.num_rows and sent.num_rows:
            code, of_sent = _codes(group, points, sent)
            order = np.argsort(code, kind="stable")
            code = code[order]
            values = np.stack([points[name].to_numpy()[order].astype(float) for name in features])
            for groups, psi, _, nodes in (
                _grown(sent, of_sent, features) if sampled else _stored(sent, of_sent)
            ):
                of, _, _, size, level, feature, cut, left = nodes
                path = level + unsuccessful_search(np.arange(size.max() + 1))[size]
                norm = unsuccessful_search(psi)
                root = np.flatnonzero(level == 0)
                trees = np.bincount(of[root], minlength=len(groups))
                begin, end = (np.searchsorted(code, groups, side) for side in ("left", "right"))
                step = max(1, CELLS // int(trees.max()))
                for at in range(begin[0], end[-1], step):
                    to = min(at + step, end[-1])
                    first = begin.clip(at, to) - at
                    rows = end.clip(at, to) - at - first
                    mine = np.flatnonzero(rows[of[root]])
                    place = np.repeat(root[mine], rows[of[root[mine]]])
                    row = _runs(first[of[root[mine]]], rows[of[root[mine]]])
                    piece = np.ascontiguousarray(values[:, at:to])
                    flat = piece.ravel()
                    for _ in range(int(level.max())):
                        right = flat[feature[place] * (to - at) + row] >= cut[place]
                        place = left[place] + right
                    total = np.bincount(row, weights=path[place], minlength=to - at)
                    in_group, here = np.repeat(np.arange(len(groups)), rows), _runs(first, rows)
                    with np.errstate(divide="ignore", invalid="ignore"):
                        mean = total[here] / trees[in_group]
                        found = -np.power(2.0, -mean / norm[in_group])
                    scores[order[at + here]], known[order[at + here]] = found, True
        column = pa.array(scores, pa.float64(), mask=~known)
        return points.drop_columns(["_lote", "_bloco"]).append_column(score, column)

    return run


def score_forest(points: DataFrame, forest: DataFrame, group, features, score="_score",
                 block_rows=BLOCK_ROWS) -> DataFrame:
    """Anomaly score of every row of a stored points table: in [-1, 0), lower is odder.

    ``forest`` is nodes, or the ``forest_samples`` they grow from. Rows of a group go to
    ``ceil(rows / block_rows)`` blocks by scan position, so copies of a row spread as well;
    groups without a forest get null.
    """
    sampled = "no" not in forest.columns
    blocks = F.ceil(F.col("_n") / F.lit(float(block_rows)))
    numbered = points.withColumn(_ID, F.monotonically_increasing_id())
    rows = group_stats(numbered, [group], _n=F.count(F.lit(1))).withColumn(
        "_bloco", F.pmod(F.col(_ID), blocks).cast("bigint")
    ).drop("_n", _ID)
    sizes = points.groupBy(F.col(group).alias("_of")).agg(F.count(F.lit(1)).alias("_n"))
    sent = (
        forest.join(sizes, F.col(group) == F.col("_of"))
        .withColumn("_bloco", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
        .drop("_of", "_n")
    )
    counted = sizes.agg(
        F.sum("_n").alias("rows"), F.sum(blocks).alias("blocks")
    ).first()
    least = points.sparkSession.sparkContext.defaultParallelism
    tasks = max(
        least,
        math.ceil((counted["rows"] or 0) / (POINTS_PER_LOT * LOTS_PER_TASK)),
        math.ceil((counted["blocks"] or 0) / ((SAMPLED if sampled else STORED) * LOTS_PER_TASK)),
    )
    lot = F.pmod(F.xxhash64(group, "_bloco"), F.lit(tasks * LOTS_PER_TASK))

    def dealt(frame):
        return frame.withColumn("_lote", lot).repartition(tasks, "_lote").groupBy("_lote")

    schema = StructType([*points.schema.fields, StructField(score, DoubleType(), True)])
    return dealt(rows).cogroup(dealt(sent)).applyInArrow(
        _score_lot(group, features, score, sampled), schema
    )
