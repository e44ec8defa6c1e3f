"""Registered queries of the training-data operators, over whole tables."""

from pyspark.sql import functions as F

from vereda.llm import (
    bpe, chat, exact, minmax, multiset, packing, phrases, queries_sql, sharding, simhash,
    spelling, suffixes, toxicity, urls,
)
from vereda.llm.common import sha256, table, vocabulary


def op1_chat_formatting(spark, sf_dir):
    extra = spark.sql(
        "SELECT * FROM VALUES (-1L, 0L, 'user', '</s>[INST] ok [/INST]'), "
        "(-1L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.conversation_digests(chat.format_turns(turns.unionByName(extra)))


def op2_document_fingerprints(spark, sf_dir):
    def second_half_replaced(text, following):
        half = F.floor(F.char_length(text) / 2).cast("int")
        return F.concat(
            F.substring(text, F.lit(1), F.char_length(text) - half),
            F.substring(following, F.lit(1), half),
        )

    rows = multiset.fingerprint_edits(table(spark, sf_dir, "documents"), second_half_replaced)
    return rows.select(
        "doc_id", "n_chars", "edited_sha256",
        multiset.as_hex(F.col("vector")).alias("fingerprint"),
        multiset.as_hex(F.col("edited_vector")).alias("edited_fingerprint"),
        multiset.likeness(F.col("vector"), F.col("edited_vector")).alias("near_edited"),
        multiset.likeness(F.col("vector"), F.col("next_vector")).alias("near_next"),
    )


def op3_simhash(spark, sf_dir):
    return simhash.near_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op4_bpe(spark, sf_dir):
    rows = bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary())
    return rows.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        sha256(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        sha256(F.col("decoded")).alias("decoded_sha256"),
    )


def op5_packing(spark, sf_dir):
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op6_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scorer = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_documents(docs, scorer, carry=["doc_id"])
    return scored.select(
        "_doc.doc_id", (F.crc32(F.col("_doc.doc_id").cast("string")) % 5 == 0).alias("held_out"),
        "score", "predicted",
    )


def op7_url_filters(spark, sf_dir):
    """A page is bad if the document its path names is labelled toxic or of low quality."""
    outcomes = table(spark, sf_dir, "labels").select(
        "doc_id",
        F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1)
        .when((F.col("quality") == 1) | (F.col("toxic") == 0), 0).alias("bad"),
    )
    return urls.judge_urls(table(spark, sf_dir, "pages"), outcomes, key="doc_id")


def op8_exact_dedup(spark, sf_dir):
    return exact.exact_groups(table(spark, sf_dir, "documents"), hash_all=True)


def op9_sharding(spark, sf_dir):
    shards = sharding.contiguous_shards(table(spark, sf_dir, "documents"), shards=8)
    return shards.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_suffix_array_dedup(spark, sf_dir):
    """Strings of 400 bytes are removed; repeated passages of over 50 words, which may be
    shorter, are only counted, in ``n_passage``."""
    rows = suffixes.remove_repeats(
        table(spark, sf_dir, "documents"), carry=["doc_id"], note=suffixes.PASSAGE
    )
    return rows.select(
        "_doc.doc_id", "n_bytes", "n_removed", "n_spans",
        F.sha2(F.col("kept"), 256).alias("kept_sha256"), F.col("n_noted").alias("n_passage"),
    )


def op11_spelling_variants(spark, sf_dir):
    return spelling.variant_groups(table(spark, sf_dir, "documents"))


def op12_minhash(spark, sf_dir):
    return minmax.near_documents(table(spark, sf_dir, "documents"))


def op13_phrase_collocations(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    name: query for name, query in list(globals().items())
    if name.startswith("op") and name[2].isdigit()
}

ORACLES = dict(queries_sql.ORACLES)
