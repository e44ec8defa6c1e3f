"""SimHash near-duplicates: fingerprints, and their links found with bit planes.

Candidates: fingerprints at most ``radius`` bits apart agree on at least two of
``radius + 2`` bands, so each distinct fingerprint goes under every pair of its bands, and all
that meet under a key are compared. Copies are one fingerprint. A key with many fingerprints
is dealt to tiles, pairs of parts, so that every two still meet in a bounded block.

Comparison: a block is stored as 64 bit planes, one long integer each with a bit per row. A
plane against itself shifted by d gives that bit of the difference for all pairs of rows d
apart; the 64 differences are summed per pair by carry-save adders on whole planes, and the
shift is abandoned as soon as every pair is beyond the radius. A block returns a spanning
forest of its links, never its pairs.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from vereda.llm.common import text_of
from vereda.llm.components import components
from vereda.session import park

SHINGLE = 4
RADIUS = 4
SEED = 42
TILE = 4096  # fingerprints of one part of a key
BATCH = 1 << 16  # rows compared at a time


def fingerprint(text: str, shingle=SHINGLE) -> int:
    """SimHash of a text, unsigned: a bit is 1 if set in over half of the shingles' hashes."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    ends = ends.tolist()
    last = min(shingle, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(line[a:b], SEED) for a, b in zip(starts, ends[last:])], dtype="<u8"
    )
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id="doc_id", text="text", shingle=SHINGLE) -> DataFrame:
    """``doc_id, fingerprint`` (as a signed bigint) and ``text_key``, a hash of the text."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text_of(text)).alias("text_key"),
        text_of(text).alias("text"),
    )

    def run(batches):
        for batch in batches:
            found = np.array(
                [fingerprint(t.as_py(), shingle) for t in batch["text"]], dtype=np.uint64
            ).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text_key"], pa.array(found)],
                names=["doc_id", "text_key", "fingerprint"],
            )

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {kind}, text_key bigint, fingerprint bigint")


def _planes(values):
    """Bit planes of uint64 values: 64 integers with bit i for row i."""
    bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(bits, axis=0, bitorder="little")
    return [int.from_bytes(packed[:, bit].tobytes(), "little") for bit in range(64)]


def _mask(flags):
    return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")


def _within(planes, shift, alive, radius):
    """Pairs (row, row + shift) of ``alive`` at most ``radius`` bits apart, as a bit mask.

    Counters hold one bit of the distance of every pair. They start so that a distance
    beyond the radius carries out of the top, into the pairs to give up.
    """
    width = (radius + 1).bit_length()
    start = (1 << width) - 1 - radius  # start + distance >= 2^width: beyond the radius
    counters = [alive if start >> k & 1 else 0 for k in range(width)]
    over = 0
    for at in range(0, 64, 2):
        x = planes[at] ^ (planes[at] >> shift)
        y = planes[at + 1] ^ (planes[at + 1] >> shift)
        low = counters[0]
        half = x ^ y
        counters[0] = low ^ half
        carry = (x & y) | (low & half)
        for k in range(1, width):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        over |= carry
        if at % 8 == 6 and not alive & ~over:
            return 0
    return alive & ~over


def _roots(parent, rows):
    found = parent[rows]
    while True:
        above = parent[found]
        if np.array_equal(above, found):
            return found
        found = above


def _root(parent, row):
    while parent[row] != row:
        row = parent[row]
    return row


def link_block(values, groups, radius=RADIUS):
    """Links between rows of one group as (row, row) of a spanning forest.

    ``values`` is uint64 and ``groups`` sorted, rows of a group together. Groups that have no
    pairs at the present shift leave the planes once they are half of the rows.
    """
    parent, edges = np.arange(len(values)), []
    rows, shift = np.arange(len(values)), 1
    while True:
        current = groups[rows]
        sizes = np.diff(np.flatnonzero(np.r_[True, current[1:] != current[:-1], True]))
        rows = rows[np.repeat(sizes > shift, sizes)]
        if not len(rows):
            return edges
        sizes = sizes[sizes > shift]
        current, planes = groups[rows], _planes(values[rows])
        while 2 * int(sizes[sizes > shift].sum()) >= len(rows):
            near = _within(planes, shift, _mask(current[shift:] == current[:-shift]), radius)
            if near:
                flags = np.frombuffer(near.to_bytes((len(rows) + 7) // 8, "little"), np.uint8)
                left = np.flatnonzero(np.unpackbits(flags, bitorder="little"))
                a, b = rows[left], rows[left + shift]
                apart = _roots(parent, a) != _roots(parent, b)
                for x, y in zip(a[apart].tolist(), b[apart].tolist()):
                    p, q = _root(parent, x), _root(parent, y)
                    if p != q:
                        parent[max(p, q)] = min(p, q)
                        edges.append((x, y))
            shift += 1


def _link_batches(radius):
    def run(batches):
        held, names = [], ("band", "key", "tile", "fingerprint")

        def flush(columns, whole):
            """Links of the groups that are complete, and the rows left over."""
            band, key, tile, values = columns
            new = np.r_[True, (band[1:] != band[:-1]) | (key[1:] != key[:-1]) | (tile[1:] != tile[:-1])]
            end = len(band) if whole else int(np.flatnonzero(new)[-1])
            groups = np.cumsum(new)[:end]
            edges = link_block(values[:end].view(np.uint64), groups, radius)
            out = None
            if edges:
                pairs = np.array(edges)
                out = pa.RecordBatch.from_arrays(
                    [pa.array(values[pairs[:, 0]]), pa.array(values[pairs[:, 1]])], names=["u", "v"]
                )
            return out, [column[end:] for column in columns]

        size = 0
        for batch in batches:
            held.append([batch[name].to_numpy(zero_copy_only=False) for name in names])
            size += batch.num_rows
            if size >= BATCH:
                columns = [np.ascontiguousarray(np.concatenate(parts)) for parts in zip(*held)]
                out, rest = flush(columns, False)
                held, size = [rest], len(rest[0])
                if out is not None:
                    yield out
        if size:
            columns = [np.ascontiguousarray(np.concatenate(parts)) for parts in zip(*held)]
            out, _ = flush(columns, True)
            if out is not None:
                yield out

    return run


def links(distinct: DataFrame, radius=RADIUS, tile=TILE) -> DataFrame:
    """``u, v``: links between distinct fingerprints at most ``radius`` bits apart.

    Not all of them, but enough that both ends of every link are connected.
    """
    bands = radius + 2
    cuts = [64 * k // bands for k in range(bands + 1)]
    value = F.col("fingerprint")

    def band(k):
        width = cuts[k + 1] - cuts[k]
        return F.shiftrightunsigned(value, cuts[k]).bitwiseAND(F.lit((1 << width) - 1))

    keys = [
        F.struct(F.lit(at).alias("band"),
                 (F.shiftleft(band(i), cuts[j + 1] - cuts[j]) + band(j)).alias("key"))
        for at, (i, j) in enumerate(combinations(range(bands), 2))
    ]
    keyed = distinct.select("fingerprint", F.inline(F.array(*keys)))
    parts = F.ceil(F.col("_size") / F.lit(tile)).cast("int")
    large = keyed.groupBy("band", "key").agg(F.count(F.lit(1)).alias("_size")).filter(
        F.col("_size") > tile
    ).select("band", "key", parts.alias("_parts"))
    own = F.pmod(F.xxhash64("fingerprint"), F.col("_parts")).cast("int")
    other = F.sequence(F.lit(0), F.col("_parts") - 1)
    tiles = F.transform(other, lambda p: F.least(p, own) * F.col("_parts") + F.greatest(p, own))
    tiled = keyed.join(large, ["band", "key"], "left").select(
        "band", "key", "fingerprint",
        F.explode(F.when(F.col("_parts").isNull(), F.array(F.lit(0))).otherwise(tiles)).alias("tile"),
    )
    return (
        tiled.repartition("band", "key", "tile")
        .sortWithinPartitions("band", "key", "tile", "fingerprint")
        .mapInArrow(_link_batches(radius), "u bigint, v bigint")
    )


def near_groups(docs: DataFrame, doc_id="doc_id", text="text", shingle=SHINGLE,
                radius=RADIUS, tile=TILE) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text_key, fingerprint, component_id``.

    Texts are lower-cased in A-Z and split at blanks; a text of fewer words than a shingle is
    one shingle, and one without words, or null, has fingerprint zero, linked like any other.
    ``component_id`` is the smallest id that links reach, null only if no row reached has an
    id. Repeated rows share their component. An empty table gives no rows. Other columns are
    not read.
    """
    marked = park(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    classes = park(
        marked.groupBy("fingerprint").agg(F.min("doc_id").alias("_smallest")), "classes"
    )
    joined = components(links(classes.select("fingerprint"), radius, tile))
    rooted = classes.join(joined, F.col("fingerprint") == F.col("node"), "left").withColumn(
        "_root", F.coalesce("root", "fingerprint")
    )
    smallest = rooted.groupBy("_root").agg(F.min("_smallest").alias("component_id"))
    named = rooted.select("fingerprint", "_root").join(smallest, "_root").drop("_root")
    return marked.join(named, "fingerprint").select(
        "doc_id", "text_key", "fingerprint", "component_id"
    )


def keep_first(docs: DataFrame, doc_id="doc_id", text="text", shingle=SHINGLE,
               radius=RADIUS) -> DataFrame:
    """The rows of ``docs`` that stay, one id and text per component, all columns unchanged.

    The smallest id stays; if it has several texts, the one with the smallest key. Rows equal
    in both all stay; exact duplicates are another operator's work.
    """
    groups = near_groups(docs, doc_id, text, shingle, radius)
    first = groups.groupBy("component_id").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key"
    )).alias("_first")).select(
        F.col("_first.doc_id").alias("_id"), F.col("_first.text_key").alias("_key")
    )
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("_doc")
    body = F.coalesce(F.col("_doc")[text], F.lit(""))
    tagged = docs.select(row).withColumn("_text_key", F.xxhash64(body))
    same = F.col("_doc")[doc_id].eqNullSafe(F.col("_id")) & (F.col("_text_key") == F.col("_key"))
    return tagged.join(first, same, "left_semi").select("_doc.*")
