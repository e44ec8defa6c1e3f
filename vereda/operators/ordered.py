"""Lags, running sums, row numbers, ranks and quantiles that survive a hot group.

All of them take one way, whatever the size of the input or of a group. The rows are put in
total order once (``place_rows``) and cut into chunks of consecutive rows. Each chunk is one
task, so no task sees more than a chunk and the rows before it that the windows look back on,
however the keys are spread. What a chunk needs from the ones before it is a few neighbouring
rows or one subtotal per group. Sums of whole numbers and decimals do not depend on the cuts.
"""

import math

from pyspark.sql import DataFrame, Window, functions as F

from vereda.session import park

ROWS_PER_TASK = 1_000_000
ACCURACY = 10_000

_TASK_BITS = 33  # monotonically_increasing_id keeps the row number of a task in the low bits


def place_rows(df: DataFrame, order, stable=False, row="_row", total="_total") -> DataFrame:
    """Number all rows 1..N by ``order``, and attach N, without a one-task sort.

    Rows equal in ``order`` are told apart by their place in the stored input, so a large
    set of copies is also spread over tasks. Both tables are written, which keeps the
    numbers the same when an executor is lost. ``stable`` says that ``df`` is a scan of
    files with row-wise steps and broadcast joins only; it is then not copied first.
    """
    stored = df if stable else park(df, "unplaced")
    ranges = max(
        df.sparkSession.sparkContext.defaultParallelism,
        math.ceil(stored.count() / ROWS_PER_TASK),
    )
    stored = stored.withColumn("_tie", F.monotonically_increasing_id())
    keys = [*order, F.col("_tie")]
    placed = park(
        stored.repartitionByRange(ranges, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id())
        .drop("_tie"),
        "placed",
    )
    task = F.shiftrightunsigned("_at", _TASK_BITS)
    in_task = F.col("_at").bitwiseAND(F.lit((1 << _TASK_BITS) - 1))
    sizes = placed.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_rows"))
    # One row per range partition: a window over all of them and a broadcast are bounded.
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_task").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    starts = sizes.select(
        "_task",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"),
        F.sum("_rows").over(everything).alias(total),
    )
    return (
        placed.withColumn("_task", task)
        .join(F.broadcast(starts), "_task")
        .withColumn(row, F.col("_start") + in_task + 1)
        .drop("_task", "_start", "_at")
    )


def _rows_of(placed, total="_total"):
    """Number of placed rows, which each of them carries."""
    row = placed.select(total).first()
    return row[0] if row else 0


def chunked_windows(placed: DataFrame, group, lags=None, running=None, lasts=None,
                    rows_per_task=ROWS_PER_TASK, row="_row") -> DataFrame:
    """Lags and running sums by ``group`` over placed rows, chunk by chunk.

    ``lags`` maps a new column to (column, distance) and needs the group to lead the placed
    order; ``running`` maps a new column to (column, extra group columns) and does not;
    ``lasts`` maps one to a column that leads the order, and gives the last row of its value.
    """
    lags, running, lasts = lags or {}, running or {}, lasts or {}
    columns = placed.columns
    halo = max([distance for _, distance in lags.values()], default=0)
    size = max(rows_per_task, halo + 1)
    placed = placed.withColumn("_own", F.expr(f"({row} - 1) div {size}"))
    if halo:
        last_rows = F.pmod(F.col(row) - 1, F.lit(size)) >= F.lit(size - halo)
        chunks = F.when(last_rows, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own"))
        spread = placed.withColumn("_chunk", F.explode(chunks))
    else:
        spread = placed.withColumn("_chunk", F.col("_own"))
    # A chunk is a task; the last one passes its neighbouring rows on to an empty one.
    spread = spread.repartitionById(_rows_of(placed) // size + 2, F.col("_chunk").cast("int"))

    mine = F.col("_chunk") == F.col("_own")
    in_chunk = Window.partitionBy("_chunk", *group).orderBy(row)
    result = spread.withColumns(
        {name: F.lag(column, distance).over(in_chunk) for name, (column, distance) in lags.items()}
    ) if lags else spread
    for name, (column, within) in running.items():
        keys = [*group, *within]
        so_far = Window.partitionBy("_chunk", *keys).orderBy(row).rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        result = result.withColumn(name, F.sum(F.when(mine, F.col(column))).over(so_far))
    for name, column in lasts.items():
        in_chunk = Window.partitionBy("_chunk", column)
        result = result.withColumn(name, F.max(F.when(mine, F.col(row))).over(in_chunk))
    result = result.filter(mine)

    for name, column in lasts.items():
        # A value that goes on into later chunks is the first of each: one row a chunk.
        firsts = placed.groupBy(F.col("_own").alias("_in")).agg(
            F.min_by(F.struct(F.col(column).alias("value")), row).alias("_first")
        )
        goes_on = placed.join(
            F.broadcast(firsts),
            (F.col("_own") == F.col("_in")) & F.col(column).eqNullSafe(F.col("_first.value")),
        ).groupBy(F.col(column).alias("_value")).agg(F.max(row).alias("_last"))
        result = (
            result.join(F.broadcast(goes_on), F.col(column).eqNullSafe(F.col("_value")), "left")
            .withColumn(name, F.greatest(name, "_last")).drop("_value", "_last")
        )
    for name, (column, within) in running.items():
        keys = [*group, *within]
        before = Window.partitionBy(*[f"_by_{key}" for key in keys]).orderBy("_by_chunk").rowsBetween(
            Window.unboundedPreceding, -1
        )
        carried = (
            placed.groupBy(
                F.col("_own").alias("_by_chunk"), *[F.col(key).alias(f"_by_{key}") for key in keys]
            )
            .agg(F.sum(column).alias("_subtotal"))
            .withColumn("_carry", F.sum("_subtotal").over(before))
            .filter(F.col("_carry").isNotNull())
            .drop("_subtotal")
        )
        same = F.col("_chunk") == F.col("_by_chunk")
        for key in keys:
            same = same & F.col(key).eqNullSafe(F.col(f"_by_{key}"))
        result = (
            result.join(carried, same, "left")
            .withColumn(name, F.coalesce(F.col(name) + F.col("_carry"), name, "_carry"))
            .drop("_carry", "_by_chunk", *[f"_by_{key}" for key in keys])
        )
    return result.select(*columns, *lags, *running, *lasts)


def ordered_windows(df: DataFrame, group, order, lags=None, running=None,
                    rows_per_task=ROWS_PER_TASK, stable=False, place=None) -> DataFrame:
    """Lags and running sums by ``group`` in ``order``; see ``chunked_windows``.

    ``order`` has to tell rows of a group apart for the result to be the same every time.
    ``stable`` is explained at ``place_rows``; ``place`` names a column for the row's number
    by group and order.
    """
    placed = place_rows(df, [*map(F.col, group), *order], stable)
    windows = chunked_windows(placed, group, lags, running, rows_per_task=rows_per_task)
    if place:
        windows = windows.withColumn(place, F.col("_row"))
    return windows.drop("_row", "_total")


def row_numbers(df: DataFrame, order, group=(), column="posicao",
                rows_per_task=ROWS_PER_TASK, stable=False) -> DataFrame:
    """Row number by ``order``, over everything or within each group."""
    if not group:
        placed = place_rows(df, order, stable)
        return placed.withColumn(column, F.col("_row")).drop("_row", "_total")
    one = df.withColumn("_one", F.lit(1).cast("bigint"))
    numbered = ordered_windows(
        one, list(group), order, running={column: ("_one", [])}, rows_per_task=rows_per_task,
        stable=stable,
    )
    return numbered.drop("_one")


def percent_ranks(df: DataFrame, value, column="percentil", counted=None,
                  rows_per_task=ROWS_PER_TASK) -> DataFrame:
    """``(rank - 1) / (rows - 1)`` by ``value`` over everything, 0 for a single row, nulls last.

    Rows are counted by value in the tasks, the values are put in order, and the share of
    smaller rows is joined back; adaptive execution broadcasts few values and splits a
    frequent one of many. The values are counted in ``counted``, a cheaper frame with the
    same rows, where there is one.
    """
    source = df if counted is None else counted
    counts = source.groupBy(F.col(value).alias("_value")).agg(F.count(F.lit(1)).alias("_rows"))
    placed = place_rows(counts, [F.col("_value").asc_nulls_last()])
    so_far = park(chunked_windows(
        placed, [], running={"_upto": ("_rows", [])}, rows_per_task=rows_per_task
    ), "ranks")
    last = so_far.agg(F.max("_upto").alias("_of"))
    share = F.coalesce(
        F.try_divide((F.col("_upto") - F.col("_rows")).cast("double"), (F.col("_of") - 1).cast("double")),
        F.lit(0.0),
    )
    # ``last`` is one row by construction.
    ranked = so_far.join(F.broadcast(last), F.col("_of").isNotNull()).select(
        "_value", share.alias(column)
    )
    return df.join(ranked, df[value].eqNullSafe(ranked["_value"])).drop("_value")


def quantile_brackets(known: DataFrame, group, value, share, accuracy=ACCURACY) -> DataFrame:
    """Values ``_from`` to ``_to`` between which each group's quantile is, and its ``_rows``.

    A sketch, merged from the tasks, gives values whose rank is off by at most one row in
    ``accuracy``. The narrowest margin is taken that covers this and the two rows the quantile
    lies between, so a long group has a bracket of about eight rows in ``accuracy``.
    """
    margins = [3.0 / accuracy, 0.002, 0.02, 0.2]
    ends = [min(max(share + side * margin, 0.0), 1.0) for margin in margins for side in (-1, 1)]
    measured = known.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(value).alias("_least"), F.max(value).alias("_most"),
        F.percentile_approx(value, ends, accuracy).alias("_ends"),
    )
    needed = F.lit(2.0 / accuracy) + F.lit(2.0) / F.col("_rows")
    low, high = F.col("_least"), F.col("_most")
    for at, margin in reversed(list(enumerate(margins))):
        fits = needed <= margin
        below = F.get("_ends", F.lit(2 * at)) if share > margin else F.col("_least")
        above = F.get("_ends", F.lit(2 * at + 1)) if share + margin < 1 else F.col("_most")
        low, high = F.when(fits, below).otherwise(low), F.when(fits, above).otherwise(high)
    return measured.select(*group, "_rows", "_least", "_most", low.alias("_from"), high.alias("_to"))


def _by_group(known, few, group):
    """``few``, one row a group, under other names, and the condition that joins it."""
    renamed = few.withColumnsRenamed({name: f"_by_{name}" for name in group})
    condition = F.lit(True)
    for name in group:
        condition = condition & known[name].eqNullSafe(renamed[f"_by_{name}"])
    return renamed, condition


def _select_quantile(known, brackets, group, value, share):
    """``_low, _high, _part`` of each group, and whether its bracket ``_missed`` the quantile."""
    few, same = _by_group(known, brackets, group)
    # Values are counted in the tasks; all below the bracket are one, which is null.
    inside = known.join(few, same).filter(F.col(value) <= F.col("_to")).groupBy(
        *group, "_rows", F.when(F.col(value) >= F.col("_from"), F.col(value)).alias("_found")
    ).agg(F.count(F.lit(1)).alias("_copies"))
    summed = ordered_windows(
        inside, group, [F.col("_found").asc_nulls_first()], running={"_upto": ("_copies", [])}
    )
    at = (F.col("_rows") - 1) * F.lit(share)
    under = F.max(F.when(F.col("_found").isNull(), F.col("_upto")))
    return summed.groupBy(*group).agg(
        F.min(F.when(F.col("_upto") > F.floor(at), F.col("_found"))).alias("_low"),
        F.min(F.when(F.col("_upto") > F.ceil(at), F.col("_found"))).alias("_high"),
        F.max(at - F.floor(at)).alias("_part"),
        (F.coalesce(under > F.max(F.floor(at)), F.lit(False))
         | (F.max("_upto") <= F.max(F.ceil(at)))).alias("_missed"),
    )


def group_quantile(df: DataFrame, group, value, share, column="limite", accuracy=ACCURACY) -> DataFrame:
    """Exact, linearly interpolated quantile of ``value`` by group, nulls left out.

    One pass finds a bracket for each group, a second counts the values in it, and only these
    are put in order. A group whose bracket does not hold the quantile after all is searched
    whole. ``df`` has to be stored: it is read twice.
    """
    known = df.filter(F.col(value).isNotNull()).select(*group, value)
    brackets = park(quantile_brackets(known, group, value, share, accuracy), "brackets")
    found = park(_select_quantile(known, brackets, group, value, share), "quantiles")
    if not found.filter("_missed").isEmpty():
        again, same = _by_group(brackets, found.filter("_missed").select(*group), group)
        wide = brackets.join(again, same, "left_semi").withColumns(
            {"_from": F.col("_least"), "_to": F.col("_most")}
        )
        found = found.filter("NOT _missed").unionByName(
            _select_quantile(known, wide, group, value, share)
        )
    low, high, part = F.col("_low"), F.col("_high"), F.col("_part")
    between = F.when(low == high, low).otherwise(low * (F.lit(1.0) - part) + high * part)
    return found.select(*group, between.alias(column))


def group_stats(df: DataFrame, group, source=None, **stats) -> DataFrame:
    """Attach aggregates of the row's group, measured on ``source`` if given.

    ``source`` is a stored frame with the same rows, for a ``df`` that would be computed twice.

    The aggregate has one row per group after map-side partials; the join back is left to
    adaptive execution, which broadcasts a small side and splits a skewed one.
    """
    by_group = (df if source is None else source).groupBy(
        *[F.col(name).alias(f"_by_{name}") for name in group]
    ).agg(
        *[aggregate.alias(name) for name, aggregate in stats.items()]
    )
    condition = F.lit(True)
    for name in group:
        condition = condition & df[name].eqNullSafe(by_group[f"_by_{name}"])
    return df.join(by_group, condition).drop(*[f"_by_{name}" for name in group])
