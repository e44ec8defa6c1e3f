"""MinHash near-duplicates: min-max signatures, banded, links confirmed on the full sets.

A document's set holds the distinct shingles of ``words`` words. Each of ``PERMUTATIONS`` hash
functions is evaluated once for a set and gives two signature values, its least and its
greatest; every band takes the pairs of two functions, four values. Sets whose similarity is
0.85 share a band but for one pair in 10^10, as 32 bands are looked at.

1. Equal sets are one class, whatever the number of copies.
2. Classes meet in the buckets of their bands. Buckets with the same members are one bucket.
3. Every class is compared with the class that leads most of its buckets. Most groups of near
   copies hang together after that.
4. Buckets that still hold several components are compared in blocks: each row outside the
   block's largest component with all rows, by counting common shingles. A block gives a
   spanning forest of the links that are new, never its pairs. A bucket beyond a block is dealt
   to tiles, pairs of parts, and one beyond ``CROWD`` classes is first split by a second band.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from vereda.llm.common import text_of
from vereda.llm.components import components
from vereda.session import park

WORDS = 5
PERCENT = 85
PERMUTATIONS = 64
BAND = 2  # permutations of a band, each with two values
TILE = 4096  # classes of one part of a bucket
TILE_SHINGLES = 4 << 20  # and their shingles
CROWD = 16 * TILE
SEED = 42
_STEP = 1024


def _odd(count, salt):
    """Fixed odd multipliers, from a rule."""
    words = [hashlib.blake2b(b"%d %d" % (salt, k), digest_size=8).digest() for k in range(count)]
    return np.frombuffer(b"".join(words), np.uint64) | np.uint64(1)


_SCALE, _SHIFT = _odd(PERMUTATIONS, 1), _odd(PERMUTATIONS, 2)
_MIX = _odd(2 * BAND, 3)


def shingle_set(text: str, words=WORDS):
    """The distinct shingles of a text as sorted 64-bit hashes.

    A-Z are lower-cased, words are runs without blanks. Fewer words than a shingle make one
    shingle of all; no words, no shingles.
    """
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    line = b" ".join(parts)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    last = min(words, len(parts)) - 1
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array(
        [digest(line[a:b], SEED) for a, b in zip(starts, ends[last:].tolist())], dtype=np.uint64
    ))


def min_max(shingles):
    """Least and greatest value of every permutation, in two rows."""
    least = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    greatest = np.zeros(PERMUTATIONS, np.uint64)
    for at in range(0, len(shingles), _STEP):
        values = shingles[at:at + _STEP, None] * _SCALE + _SHIFT
        np.minimum(least, values.min(axis=0), out=least)
        np.maximum(greatest, values.max(axis=0), out=greatest)
    return np.array([least, greatest])


def band_keys(signature):
    """One 64-bit key for every band, different for different bands."""
    values = np.concatenate([signature[0].reshape(-1, BAND), signature[1].reshape(-1, BAND)], axis=1)
    values ^= values >> np.uint64(29)
    keys = (values * _MIX).sum(axis=1, dtype=np.uint64) + np.arange(len(values), dtype=np.uint64)
    keys ^= keys >> np.uint64(32)
    return (keys * _MIX[0]).view(np.int64)


def _sketch(words):
    def run(batches):
        for batch in batches:
            sizes, high, low, bands = [], [], [], []
            for text in batch["text"]:
                found = shingle_set(text.as_py(), words)
                sizes.append(len(found))
                digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                a, b = np.frombuffer(digest, np.int64).tolist()
                high.append(a)
                low.append(b)
                bands.append(band_keys(min_max(found)) if len(found) else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text_key"], pa.array(sizes, pa.int64()),
                 pa.array(high, pa.int64()), pa.array(low, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "text_key", "n", "a", "b", "bands"],
            )

    return run


def _shingles(words):
    def run(batches):
        for batch in batches:
            found = [shingle_set(text.as_py(), words).view(np.int64) for text in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["cls"], pa.array(found, pa.list_(pa.int64()))], names=["cls", "shingles"]
            )

    return run


def _buckets(keyed):
    """``key, cls, n, size, leader, weight``: one bucket for each list of two or more classes.

    Buckets of the same members are told by their number and two hashes of all of them; the
    one with the smallest key stays, and ``weight`` counts them.
    """
    found = keyed.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"), F.min("cls").alias("leader"), F.sum("n").alias("load"),
        F.bit_xor(F.xxhash64("cls")).alias("x"),
        F.bit_xor(F.xxhash64("cls", F.lit("second"))).alias("y"),
    ).filter("size > 1")
    lists = park(found.groupBy("size", "x", "y").agg(
        F.min(F.struct("key", "leader", "load")).alias("one"), F.count(F.lit(1)).alias("weight"),
    ).select("one.*", "size", "weight"), "bucket-lists")
    return park(keyed.join(lists, "key"), "buckets")


def _split_crowded(members, crowd):
    """Buckets; the classes of a crowded one meet under every second bucket they share too."""
    crowded = park(members.filter(F.col("size") > crowd).select("key", "cls", "n"), "crowded")
    if not crowded.limit(1).count():
        return members
    second = members.select("cls", F.col("key").alias("other"))
    keyed = crowded.join(second, "cls").filter("key <> other").select(
        F.xxhash64(F.least("key", "other"), F.greatest("key", "other")).alias("key"), "cls", "n"
    ).distinct()
    return members.filter(F.col("size") <= crowd).unionByName(_buckets(keyed))


def link_sets(labels, sets, percent=PERCENT):
    """Links between rows of different labels, as pairs of rows of a spanning forest.

    ``sets`` are arrays of distinct shingles. Only rows outside the most frequent label are
    compared, each with all rows; a row that joins it in the meantime need not be.
    """
    sizes = np.array([len(s) for s in sets])
    _, label = np.unique(np.asarray(labels), return_inverse=True)
    label = label.copy()
    _, tokens = np.unique(np.concatenate(sets), return_inverse=True)
    own = np.repeat(np.arange(len(sets)), sizes)
    counts = np.bincount(tokens)
    common = counts[tokens] > 1
    tokens, own = tokens[common], own[common]
    starts = np.searchsorted(own, np.arange(len(sets) + 1))
    flags = np.zeros(len(counts), bool)
    main = int(np.bincount(label).argmax())
    edges = []
    for row in np.flatnonzero(label != main).tolist():
        if label[row] == main:
            continue
        mine = tokens[starts[row]:starts[row + 1]]
        flags[mine] = True
        shared = np.bincount(own[flags[tokens]], minlength=len(sets))
        flags[mine] = False
        near = 100 * shared >= percent * (sizes[row] + sizes - shared)
        while True:
            others = np.flatnonzero(near & (label != label[row]))
            if not len(others):
                break
            other = int(others[0])
            edges.append((row, other))
            keep, gone = (main, label[row]) if label[other] == main else (label[row], label[other])
            label[label == gone] = keep
    return edges


def _link_blocks(percent):
    def links(rows):
        ids, roots, sets = zip(*rows)
        return [(ids[x], ids[y]) for x, y in link_sets(roots, sets, percent)]

    def out(pairs):
        return pa.RecordBatch.from_arrays(
            [pa.array(side, pa.int64()) for side in zip(*pairs)], names=["u", "v"]
        )

    def run(batches):
        block, rows = None, []
        for batch in batches:
            shingles = batch["shingles"]
            for at, (key, tile, cls, root) in enumerate(zip(*[
                batch[name].to_pylist() for name in ("key", "tile", "cls", "root")
            ])):
                if (key, tile) != block:
                    pairs = links(rows) if len(rows) > 1 else ()
                    if pairs:
                        yield out(pairs)
                    block, rows = (key, tile), []
                rows.append((cls, root, shingles[at].values.to_numpy()))
        pairs = links(rows) if len(rows) > 1 else ()
        if pairs:
            yield out(pairs)

    return run


def _confirmed(pairs, sets, percent):
    """The pairs (u, v) whose full sets are similar enough."""
    left = sets.select(F.col("cls").alias("u"), F.col("shingles").alias("_a"))
    right = sets.select(F.col("cls").alias("v"), F.col("shingles").alias("_b"))
    shared = F.size(F.array_intersect("_a", "_b"))
    union = F.size("_a") + F.size("_b") - F.col("_shared")
    return pairs.join(left, "u").join(right, "v").withColumn("_shared", shared).filter(
        100 * F.col("_shared") >= percent * union
    ).select("u", "v")


def near_documents(docs: DataFrame, doc_id="doc_id", text="text", words=WORDS, percent=PERCENT,
                   tile=TILE, crowd=CROWD) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked when ``percent`` or more of the union of their shingle sets is common;
    ``component_id`` is the smallest id that links reach. A text without words, or null, has no
    shingles and is linked with nothing, so it keeps its own id. Equal sets are linked. Repeated
    rows are rows of their own and share a component; a null id has the smallest id it reaches,
    null if there is none, and ``kept`` says that id and component are the same. A very long
    text is one set, held by one task at a time; a block with such sets has fewer rows. Other
    columns are not read, so their names may clash. An empty table gives no rows.
    """
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), text_of(f"`{text}`").alias("text")
    ).withColumn("text_key", F.xxhash64("text"))
    kind = dict(rows.dtypes)["doc_id"]
    marked = park(rows.mapInArrow(
        _sketch(words), f"doc_id {kind}, text_key bigint, n bigint, a bigint, b bigint, bands array<bigint>"
    ), "sketches")
    classes = park(marked.filter("n > 0").groupBy("a", "b").agg(
        F.min("doc_id").alias("smallest"), F.min(F.struct("doc_id", "text_key")).alias("one"),
        F.first("n").alias("n"), F.first("bands").alias("bands"),
    ).withColumn("cls", F.monotonically_increasing_id()), "classes")

    members = _split_crowded(
        _buckets(classes.select("cls", "n", F.explode("bands").alias("key"))), crowd
    )
    wanted = classes.join(members.select("cls").distinct(), "cls", "left_semi").select(
        "cls", F.col("one.doc_id").alias("_id"), F.col("one.text_key").alias("_key")
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))
    sets = park(
        rows.join(wanted, same).select("cls", "text").dropDuplicates(["cls"])
        .mapInArrow(_shingles(words), "cls bigint, shingles array<bigint>"), "shingle-sets",
    )

    led = members.filter("leader <> cls").groupBy("cls", "leader").agg(F.sum("weight").alias("_w"))
    first = led.groupBy("cls").agg(F.max(F.struct("_w", "leader")).alias("_best")).select(
        F.col("cls").alias("u"), F.col("_best.leader").alias("v")
    )
    links = park(_confirmed(first, sets, percent), "first-links")
    grouped = members.join(
        components(links).select(F.col("node").alias("cls"), "root"), "cls", "left"
    ).withColumn("root", F.coalesce("root", "cls"))
    grouped = park(grouped.select("key", "cls", "root", "size", "load"), "grouped-buckets")
    mixed = grouped.groupBy("key").agg(
        (F.min("root") != F.max("root")).alias("_mixed"), F.first("size").alias("_size"),
        F.first("load").alias("_load"),
    ).filter("_mixed").select("key", F.greatest(
        F.ceil(F.col("_size") / F.lit(tile)), F.ceil(F.col("_load") / F.lit(TILE_SHINGLES))
    ).cast("int").alias("_parts"))
    own = F.pmod(F.xxhash64("cls"), F.col("_parts")).cast("int")
    tiles = F.transform(
        F.sequence(F.lit(0), F.col("_parts") - 1),
        lambda p: F.least(p, own) * F.col("_parts") + F.greatest(p, own),
    )
    blocks = grouped.join(mixed, "key").select("key", "cls", "root", F.explode(tiles).alias("tile"))
    more = (
        blocks.join(sets, "cls").select("key", "tile", "cls", "root", "shingles")
        .repartition("key", "tile").sortWithinPartitions("key", "tile")
        .mapInArrow(_link_blocks(percent), "u bigint, v bigint")
    )
    joined = components(links.unionByName(more))

    rooted = park(classes.join(
        joined.select(F.col("node").alias("cls"), "root"), "cls", "left"
    ).select("a", "b", "smallest", F.coalesce("root", "cls").alias("root")), "rooted")
    lowest = rooted.groupBy("root").agg(F.min("smallest").alias("component"))
    named = rooted.join(lowest, "root").select("a", "b", "component")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component"))
    return marked.join(named, ["a", "b"], "left").withColumn("component_id", component).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
