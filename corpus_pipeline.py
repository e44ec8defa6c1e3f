"""A cleaning pipeline over ``documents``: five of the training-data operators in a row."""

from pyspark.sql import functions as F

from vereda.llm import exact, packing, simhash, suffixes, toxicity
from vereda.llm.common import table, vocabulary
from vereda.session import park


def drop_toxic(spark, docs, sf_dir):
    """The documents that a scorer trained on the labels does not reject."""
    scorer = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, scorer).filter("predicted = 0").select("_doc.*")


def drop_exact_copies(spark, docs, sf_dir):
    """One document of each group of texts that are equal but for blanks."""
    return exact.keep_exact(docs)


def drop_near_copies(spark, docs, sf_dir):
    """One document of each group of linked fingerprints: 4 words a shingle, 4 bits apart."""
    return simhash.keep_first(docs)


def cut_repeats(spark, docs, sf_dir):
    """Texts without passages that occur more than once, and their new length.

    A passage has ``suffixes.PASSAGE`` bytes or more, which takes in those of over 50 words.
    A document of repeated passages alone stays, with an empty text.
    """
    rest = suffixes.remove_repeats(docs, as_text=True, length=suffixes.PASSAGE)
    changed = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast("bigint")}
    return rest.select(*[
        changed[name].alias(name) if name in changed else F.col("_doc")[name].alias(name)
        for name in docs.columns
    ])


def pack(spark, docs, sf_dir):
    """Pieces of the documents in sequences of 4096 tokens."""
    pieces = packing.pack_documents(docs, vocabulary())
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("simhash near-dedup", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("packing", pack),
]
#: No SQL has a trained scorer, SimHash links or BPE; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply the stages to ``documents``, each result written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = park(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
