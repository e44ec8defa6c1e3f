"""Contiguous shards of equal bytes, cut from global prefix sums.

Rows are sorted by id once. Each sorted partition sums its own sizes as it is written; the
partition totals, one row each, give every partition its offset, and a row's global offset
alone decides its shard. No task sees more than its own range of ids.
"""

from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from vereda.llm.common import text_of
from vereda.session import park


def _running_totals(batches):
    """Number the rows of a sorted partition and sum the sizes before each."""
    part, before, place = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        sums = batch["size"].cumsum()
        batch["part"] = part
        batch["place"] = range(place, place + len(batch))
        batch["before"] = sums - batch["size"] + before
        before, place = before + int(sums.iloc[-1]) if len(batch) else before, place + len(batch)
        yield batch


def contiguous_shards(docs: DataFrame, shards=8, doc_id="doc_id", text="text") -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, shard, slot``.

    Size is the UTF-8 bytes of the text plus one; a null text has none. Documents are laid end
    to end by (id, size, crc32), null ids first, and the row whose middle byte falls into the
    n-th equal part of all bytes goes to shard n: shards are contiguous and differ from the
    target by less than one document. ``slot`` counts from 0 in each shard. Rows equal in all
    three are interchangeable. An empty table gives no rows. Other columns are not read.
    """
    sizes = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(text_of(text)) + F.lit(1)).cast("bigint").alias("size"),
        F.crc32(text_of(text)).alias("text_crc32"),
    )
    order = ["doc_id", "size", "text_crc32"]
    placed = park(
        sizes.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(
            _running_totals,
            "doc_id " + dict(sizes.dtypes)["doc_id"]
            + ", size bigint, text_crc32 bigint, part int, place bigint, before bigint",
        ),
        "shard-sizes",
    )
    totals = placed.groupBy("part").agg(
        F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows")
    )
    # One row per partition: the windows and the broadcast are bounded by their number.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("_bytes").over(earlier), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
        F.sum("_bytes").over(every).alias("_all_bytes"),
    )
    middle = F.expr(
        f"(2 * (before + _bytes_before) + size) * {int(shards)} div (2 * _all_bytes)"
    )
    sharded = placed.join(F.broadcast(offsets), "part").select(
        "doc_id", "size", "text_crc32",
        F.least(middle, F.lit(shards - 1)).cast("int").alias("shard"),
        (F.col("place") + F.col("_rows_before")).alias("_row"),
    )
    firsts = sharded.groupBy("shard").agg(F.min("_row").alias("_first"))
    return sharded.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_row") - F.col("_first")).alias("slot")
    )
