"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Native expressions only. The cheap signature of every row is stored; rows that share it with
another row are read in full, the others never are.
"""

from pyspark.sql import DataFrame, functions as F

from vereda.llm.common import SPACES, sha256
from vereda.session import park

PREFIX = 64


def normalised(column):
    """The text without blanks, tabs and line ends."""
    return F.regexp_replace(column, SPACES, "")


def _signed(docs, doc_id, text, carry):
    """Id, length in code points, normalised text and its signature; all else only if carried."""
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    body = F.coalesce(F.col("_doc")[text], F.lit(""))
    return docs.select(row.alias("_doc")).select(
        F.col("_doc")[doc_id].alias("doc_id"), F.char_length(body).alias("_chars"),
        normalised(body).alias("_plain"), *(["_doc"] if carry else []),
    ).withColumns({
        "_length": F.octet_length("_plain"),
        "_prefix": F.xxhash64(F.substring("_plain", 1, PREFIX)),
    })


def surviving_signatures(rows: DataFrame) -> DataFrame:
    """(length, prefix hash) pairs that more than one row has, refined in two steps."""
    signatures = park(rows.select("_length", "_prefix"), "signatures")
    lengths = signatures.groupBy("_length").count().filter("count > 1").drop("count")
    return park(
        signatures.join(lengths, "_length", "left_semi")
        .groupBy("_length", "_prefix").count().filter("count > 1").drop("count"), "pairs",
    )


def _refined(docs, doc_id, text, hash_all, carry):
    """Rows that share their full hash's signature, grouped, and rows that stand alone."""
    rows = _signed(docs, doc_id, text, carry)
    keys, more = ["_length", "_prefix"], ["_doc"] if carry else []
    pairs = surviving_signatures(rows)
    full = sha256(F.col("_plain"))
    hashed = park(
        rows.join(pairs, keys, "left_semi").select(
            "doc_id", "_chars", full.alias("text_sha256"),
            F.monotonically_increasing_id().alias("_row"), *more,
        ),
        "hashed",
    )
    best = F.min(F.struct(
        (-F.col("_chars")).alias("chars"), F.col("doc_id").isNull().alias("unnamed"),
        "doc_id", "_row",
    ))
    groups = hashed.groupBy("text_sha256").agg(
        best.alias("_best"), F.count(F.lit(1)).alias("group_size")
    )
    grouped = hashed.join(groups, "text_sha256").select(
        "doc_id", F.col("_best.doc_id").alias("keep_id"), "group_size",
        (F.col("_row") == F.col("_best._row")).alias("kept"), "text_sha256", *more,
    )
    own_hash = full if hash_all else F.lit(None).cast("string")
    alone = rows.select("doc_id", *keys, own_hash.alias("text_sha256"), *more).join(
        pairs, keys, "left_anti"
    ).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256", *more,
    )
    return grouped, alone


def exact_groups(docs: DataFrame, doc_id="doc_id", text="text", hash_all=False) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are after deleting blanks; null counts as empty. The row with
    the most code points of original text stays, of those the smallest id, null ids last; of
    wholly equal rows exactly one is marked as kept. ``text_sha256`` is the full hash; rows
    that drop out before the last step have null there unless ``hash_all`` is set. An empty
    table gives no rows. Other columns are not read.
    """
    grouped, alone = _refined(docs, doc_id, text, hash_all, carry=False)
    return grouped.unionByName(alone)


def keep_exact(docs: DataFrame, doc_id="doc_id", text="text") -> DataFrame:
    """The rows of ``docs`` that stay, one per group of equal texts, all columns unchanged."""
    grouped, alone = _refined(docs, doc_id, text, hash_all=False, carry=True)
    return grouped.filter("kept").select("_doc.*").unionByName(alone.select("_doc.*"))
