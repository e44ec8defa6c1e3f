"""Homomorphic multiset hash of a document's paragraphs.

A paragraph hashes to a wide vector and a document to the sum of its paragraphs' vectors
modulo powers of two. Sums do not depend on order, and a paragraph is inserted or deleted by
one addition or subtraction. Native expressions only.

A vector is an array of bigints: the number of paragraphs, the sums of the 32-bit halves of
``WORDS`` hashes modulo 2^32, and for every one of their lowest 63 bits the number of hashes
that have it, modulo 2^20. The halves tell documents apart; in the counting lanes the squared
difference of two documents estimates in how many paragraphs they differ.
"""

from pyspark.sql import DataFrame, Window, functions as F

from vereda.llm.common import text_of

WORDS = 2
HALVES = 2 * WORDS
LANES = 63 * WORDS
_SHIFTS = 21  # shifts of a hash that bring each of its 63 bits into one of three fields
_FIELDS = 1 | 1 << 21 | 1 << 42
_BLOCK = 1 << 20  # paragraphs that fields of 21 bits can count


def paragraphs(text):
    """Lines, and sentences within a line. An empty text is one empty paragraph."""
    for mark in ".!?":
        text = F.replace(text, F.lit(mark + " "), F.lit(mark + "\n"))
    return F.split(text, "\n")


def _moduli():
    powers = [1 << 62] + [1 << 32] * HALVES + [1 << 20] * LANES
    return F.array(*[F.lit(power).cast("bigint") for power in powers])


def insert(vector, other):
    """Sum of two vectors: the paragraphs of both."""
    sums = F.zip_with(vector, other, lambda a, b: a + b)
    return F.zip_with(sums, _moduli(), F.pmod)


def delete(vector, other):
    """``vector`` without the paragraphs of ``other``."""
    return F.zip_with(F.zip_with(vector, other, lambda a, b: a - b), _moduli(), F.pmod)


def vectors(rows: DataFrame, keys, body: str, column="vector") -> DataFrame:
    """``keys`` and the vector of the text in ``body``, one row per distinct keys.

    Paragraphs are rows of their own only within a task: they are summed there before
    anything moves, and nothing does if the rows are already partitioned by some of the keys.
    A text is summed in blocks, so that no packed field overflows however long it is.
    """
    split = rows.select(*keys, F.posexplode(paragraphs(F.col(body))).alias("_at", "_paragraph"))
    words = [f"_hash{word}" for word in range(WORDS)]
    hashed = split.select(
        *keys, F.shiftright("_at", _BLOCK.bit_length() - 1).alias("_block"),
        *[F.xxhash64("_paragraph", F.lit(at)).alias(word) for at, word in enumerate(words)],
    )
    low = F.lit((1 << 32) - 1)
    sums = [F.count(F.lit(1)).alias("_count")]
    for word in words:
        sums.append(F.sum(F.col(word).bitwiseAND(low)).alias(f"{word}_low"))
        sums.append(F.sum(F.shiftrightunsigned(word, 32)).alias(f"{word}_high"))
    for word in words:
        for by in range(_SHIFTS):
            fields = F.shiftrightunsigned(word, by).bitwiseAND(F.lit(_FIELDS))
            sums.append(F.sum(fields).alias(f"{word}_bit{by}"))
    blocks = hashed.groupBy(*keys, "_block").agg(*sums)

    def field(name, at):
        return F.shiftrightunsigned(name, at).bitwiseAND(F.lit((1 << 20) - 1))

    numbers = [F.col("_count")]
    numbers += [
        F.pmod(f"{word}_{half}", F.lit(1 << 32)) for word in words for half in ("low", "high")
    ]
    numbers += [
        field(f"{word}_bit{by}", at)
        for word in words for by in range(_SHIFTS) for at in (0, 21, 42)
    ]
    parts = blocks.select(*keys, F.array(*numbers).alias("_part")).groupBy(*keys).agg(
        F.collect_list("_part").alias("_parts")
    )
    first = F.get("_parts", F.lit(0))
    rest = F.slice("_parts", F.lit(2), F.size("_parts"))
    return parts.select(*keys, F.when(F.size("_parts") == 1, first).otherwise(
        F.aggregate(rest, first, insert)
    ).alias(column))


def as_hex(vector):
    """The vector as text: eight hex digits for the count and each half, five for a lane."""

    def digits(numbers, width):
        return F.array_join(F.transform(numbers, lambda x: F.lpad(F.hex(x), width, "0")), "")

    return F.lower(F.concat(
        digits(F.slice(vector, 1, 1 + HALVES), 8), digits(F.slice(vector, 2 + HALVES, LANES), 5)
    ))


def likeness(a, b):
    """Share of common paragraphs of two vectors, 0 to 1, estimated from the counting lanes.

    ``2 * common / (paragraphs of both)``. The difference in a lane, as a sum of signs, has
    the squared norm of the multiset difference as its mean square. Equal vectors give 1.
    Exact to about one part in eight, and meant for texts of less than 500,000 paragraphs.
    """
    half, whole = F.lit(1 << 19), F.lit(1 << 20)
    more = F.get(a, F.lit(0)) - F.get(b, F.lit(0))
    # Sum of (2d - more)^2 over the lanes, from the sums of d and of d^2.
    apart = F.zip_with(
        F.slice(a, 2 + HALVES, LANES), F.slice(b, 2 + HALVES, LANES),
        lambda x, y: F.pmod(x - y + half, whole) - half,
    )
    sums = F.aggregate(
        apart, F.struct(F.lit(0).cast("bigint").alias("d"), F.lit(0).cast("bigint").alias("dd")),
        lambda total, d: F.struct((total["d"] + d).alias("d"), (total["dd"] + d * d).alias("dd")),
        lambda total: F.lit(4) * total["dd"] - F.lit(4) * more * total["d"]
        + F.lit(LANES) * more * more,
    )
    both = (F.get(a, F.lit(0)) + F.get(b, F.lit(0))).cast("double")
    share = F.lit(1.0) - F.try_divide(sums.cast("double"), F.lit(float(LANES)) * both)
    return F.when(a == b, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), share))


def _bucket(key, bounds):
    """Number of bounds at or below a key, by binary search; 0 for a null key."""
    if not bounds:
        return F.lit(0)
    values = F.array(*[F.lit(float(bound)) for bound in bounds])
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    return F.aggregate(
        F.array(*map(F.lit, steps)), F.lit(0),
        lambda low, step: F.when(
            F.coalesce(F.get(values, low + step - 1) <= key.cast("double"), F.lit(False)),
            low + step,
        ).otherwise(low),
    )


def in_ranges(rows: DataFrame, key: str) -> DataFrame:
    """Deal rows to ranges of ``key``, with the first rows of each also at the end of the
    range before, the first range following the last.

    Adds ``_range`` and ``_ghost``, which marks the added rows: a window over ``_range`` then
    sees the row that follows any of its own. Null keys come first. ``key`` is a number;
    ranges follow its quantiles, twice as many as shuffle partitions.
    """
    spark = rows.sparkSession
    ranges = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = sorted(set(rows.select(F.col(key).cast("double").alias("_k")).approxQuantile(
        "_k", [k / ranges for k in range(1, ranges)], 0.25 / ranges
    )))
    bucket = _bucket(F.col(key), bounds)
    by_range = Window.orderBy("_at")
    firsts = rows.select(key, bucket.alias("_at")).groupBy("_at").agg(
        F.min(F.struct(F.col(key).isNotNull().alias("known"), F.col(key).alias("key"))).alias("_f")
    ).select(
        "_at", F.col("_f.key").alias("_first"),
        F.coalesce(F.lag("_at").over(by_range), F.max("_at").over(Window.partitionBy()))
        .alias("_previous"),
    )
    # One row per range: bounded by the number of ranges.
    marked = rows.withColumn("_own", bucket).join(F.broadcast(firsts), F.col("_own") == F.col("_at"))
    own = F.struct(F.col("_own").alias("_range"), F.lit(False).alias("_ghost"))
    ghost = F.struct(F.col("_previous").alias("_range"), F.lit(True).alias("_ghost"))
    return marked.select(*rows.columns, F.inline(
        F.when(F.col(key).eqNullSafe(F.col("_first")), F.array(own, ghost)).otherwise(F.array(own))
    ))


def fingerprint_documents(docs: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """``doc_id, vector`` of every row. Null texts count as empty, repeated rows each have a
    row, an empty table gives none. Other columns are not read."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), text_of(text).alias("text"),
        F.monotonically_increasing_id().alias("_row"),
    )
    return vectors(rows, ["_row", "doc_id"], "text").select("doc_id", "vector")


def fingerprint_edits(docs: DataFrame, edited_of, doc_id="doc_id", text="text") -> DataFrame:
    """Fingerprints of every text, of its edited text and of the next document.

    ``edited_of(text, next_text)`` gives the edited text. ``doc_id, n_chars, edited_sha256,
    vector, edited_vector, next_vector``. Null texts count as empty. Documents follow each
    other by id, null ids first, then by a hash of the text; the last is followed by the
    first, and a single one by itself. Rows equal in both are neighbours and interchangeable.
    An empty table gives no rows. Other columns are not read.

    Texts move once, to the ranges of ids; paragraphs are summed there.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), text_of(text).alias("text"),
        F.xxhash64(text_of(text)).alias("tie"),
    )
    order = Window.partitionBy("_range").orderBy("_ghost", F.col("doc_id").asc_nulls_first(), "tie")
    pairs = in_ranges(rows, "doc_id").withColumn("next_text", F.lead("text").over(order)).select(
        "_range", "_ghost", "doc_id", "tie", F.monotonically_increasing_id().alias("_row"),
        F.char_length("text").cast("bigint").alias("n_chars"), "text",
        F.coalesce(edited_of(F.col("text"), F.col("next_text")), F.lit("")).alias("edited"),
    ).withColumn("edited_sha256", F.sha2("edited", 256))
    keys = ["_range", "_ghost", "doc_id", "tie", "_row", "n_chars", "edited_sha256"]
    bodies = pairs.select(*keys, F.inline(F.array(
        F.struct(F.lit(False).alias("_edited"), F.col("text").alias("_body")),
        F.struct(F.lit(True).alias("_edited"), F.col("edited").alias("_body")),
    )))
    both = vectors(bodies, [*keys, "_edited"], "_body").groupBy(*keys).agg(
        *[F.get(F.collect_list(F.when(F.col("_edited") == edited, F.col("vector"))), F.lit(0))
          .alias(name) for edited, name in ((False, "vector"), (True, "edited_vector"))]
    )
    return both.withColumn("next_vector", F.lead("vector").over(order)).filter("NOT _ghost").select(
        "doc_id", "n_chars", "edited_sha256", "vector", "edited_vector", "next_vector"
    )
