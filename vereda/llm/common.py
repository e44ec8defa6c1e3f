"""Helpers the operators share."""

import ctypes
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column="text"):
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def sha256(column):
    """Lowercase hex of the SHA-256 of a string in UTF-8."""
    return F.sha2(column, 256)


def hex_digest(*parts) -> str:
    digest = hashlib.sha256()
    for part in parts:
        digest.update(part)
    return digest.hexdigest()


def vocabulary(name="word_bpe_49k.json") -> str:
    """Place of a public tokenizer file, the same on every machine that has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def frugal(run, rows=1000):
    """``run`` for ``mapInArrow`` on at most ``rows`` rows at a time, whose worker gives memory
    back to the system when the task ends. Workers serve many tasks, and what one stage needed
    would otherwise count against the next."""
    def wrapped(batches):
        yield from run(
            batch.slice(at, rows) for batch in batches for at in range(0, batch.num_rows, rows)
        )
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return wrapped
