"""Chat formatting, fingerprints, BPE, packing and sharding against plain versions."""

import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vereda.llm import bpe, chat, multiset, packing, queries, sharding
from vereda.llm.common import vocabulary

FOLDER = "/root/testdata/sf0.001"
ODD = [
    None, "", "   \n\t ", "a", "Foo's BAR, baz!!  don't we'll 123", "ÉCOLE ñandú straße İstanbul ſ",
    "e\u0301 cafe\u0301 \u00a0x\u2003y\u3000z\x1cq", "<|endoftext|> and<|startoftext|>x", "日本語 テスト 😀👍🏽 ok",
    "word " * 3000, "x" * 3000, "ab<|endoftext|>" * 300, "zażółć gęślą jaźń " * 60, "\x00 \x0b\x0c", "a" * 1000 + " b",
]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def docs_of(spark, texts, extra=True):
    rows = [(at, text, "x", 1.5) for at, text in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, kept string, _row double")
    return frame if extra else frame.select("doc_id", "text")


# Chat


def test_chat_round_trip(spark):
    odd = ["</s>[INST] ok [/INST]", "\\", "\\\\<s>", "[\\INST]", " [/INST]", "", None, "[END][ROLE]x[/ROLE] ", "<"]
    rows = [(c, t, role, text) for c, role in enumerate(["user", "assistant", "system", "to\\ol[/ROLE] ", None])
            for t, text in enumerate(odd)]
    rows += [(None, 1, "user", "a"), (None, None, "assistant", "b"), (0, 0, "user", odd[0])]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv_id: r for r in chat.conversation_digests(chat.format_turns(frame)).collect()}
    whole = {r.conv_id: r for r in chat.format_conversations(frame).collect()}
    assert set(got) == {row[0] for row in rows} == set(whole)
    for conv, row in got.items():
        turns = sorted(((t is not None, t or 0, role or "", text or "")) for c, t, role, text in rows if c == conv)
        loss = "".join(text for *_, role, text in turns if role == "assistant")
        assert row.n_turns == len(turns)
        assert row.turns_sha256 == sha("".join(f"{role}\n{text}\n" for *_, role, text in turns))
        assert (row.loss_chars, row.loss_sha256) == (len(loss), sha(loss))
        text = whole[conv].formatted
        assert row.formatted_chars == len(text)
        learned = [chat.unescape(text[a:b]) for a, b in zip(whole[conv].starts, whole[conv].ends)]
        assert "".join(learned) == loss


def test_chat_empty(spark):
    none = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.conversation_digests(chat.format_turns(none)).count() == 0


def test_template_language():
    folded = chat.fold(chat.parse("a{{ 'b' + 1 }}{% if 1 == 2 %}no{% elif not false %}c{% endif %}"))
    assert folded == [("text", "ab1c")]
    piece, spans = chat.Template(
        "<{% for turn in turns %}{{ loop.index0 }}{% generation %}{{ turn.text | trim | upper }}"
        "{% endgeneration %}{% if not loop.last %},{% endif %}{% endfor %}>"
    ).piece("user", " x ", 0, True)
    assert piece == "<0X>" and spans == [(2, 3)]
    for wrong in ["{{ turn.__class__ }}", "{% for x in turns %}{% endfor %}", "{{ open('x') }}", "{{ 'a' | eval }}",
                  "{% if 1 %}", "{{ 1 + }}", "no loop", "{% include 'x' %}{% for turn in turns %}{% endfor %}"]:
        with pytest.raises(chat.TemplateError):
            chat.Template(wrong)


# Fingerprints


def plain_vector(text):
    for mark in ".!?":
        text = text.replace(mark + " ", mark + "\n")
    return Counter(text.split("\n"))


def test_fingerprint_of_multisets(spark):
    texts = ["a b. c d.\ne", "e\nc d.\na b.", "a b.\nc d.", "", None, "x\nx", "x", "e"]
    rows = {r.doc_id: r.vector for r in multiset.fingerprint_documents(docs_of(spark, texts)).collect()}
    assert len(rows) == len(texts)
    assert rows[0] == rows[1] and rows[3] == rows[4]
    assert len({tuple(v) for v in rows.values()}) == 6
    frame = spark.createDataFrame([(rows[0], rows[2], rows[7])], "a array<bigint>, b array<bigint>, c array<bigint>")
    done = frame.select(multiset.insert(F.col("b"), F.col("c")).alias("whole"),
                        multiset.delete(F.col("a"), F.col("c")).alias("less"),
                        multiset.likeness(F.col("a"), F.col("a")).alias("same")).first()
    assert done.whole == rows[0] and done.less == rows[2] and done.same == 1.0


def test_fingerprints_in_blocks(spark, monkeypatch):
    texts = ["\n".join(f"p{i % 7}" for i in range(50))]
    whole = multiset.fingerprint_documents(docs_of(spark, texts)).first().vector
    monkeypatch.setattr(multiset, "_BLOCK", 8)
    assert multiset.fingerprint_documents(docs_of(spark, texts)).first().vector == whole


def test_fingerprint_edits(spark):
    texts = ["0123456789\nabc", "Ünï\nx", None, "", "a.\n" * 40, "a.\n" * 40]
    ids = [5, 3, None, 9, 7, 7]
    frame = spark.createDataFrame(list(zip(ids, texts)), "doc_id bigint, text string")

    def edited(text, following):
        half = F.floor(F.char_length(text) / 2).cast("int")
        return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(following, F.lit(1), half))

    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_chars, r.edited_sha256)
                 for r in multiset.fingerprint_edits(frame, edited).collect())
    order = sorted(zip(ids, texts), key=lambda row: (row[0] is not None, row[0] or 0))
    want = []
    for at, (doc, text) in enumerate(order):
        text, following = text or "", order[(at + 1) % len(order)][1] or ""
        half = len(text) // 2
        want.append((doc is not None, doc or 0, len(text), sha(text[:len(text) - half] + following[:half])))
    assert got == sorted(want)
    assert multiset.fingerprint_edits(frame.limit(0), edited).count() == 0
    one = multiset.fingerprint_edits(frame.filter("doc_id = 5"), edited).first()
    assert one.vector == one.next_vector


def test_likeness_tells_edits(spark):
    rows = queries.op2_document_fingerprints(spark, FOLDER)
    means = rows.filter("n_chars > 500").agg(F.avg("near_edited"), F.avg("near_next"), F.max("near_edited")).first()
    assert 0.3 < means[0] < 0.7 and means[1] < 0.15 and means[2] <= 1


# BPE and packing


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(vocabulary())
    return lambda text: found.encode(text or "", add_special_tokens=False).ids, found


def test_bpe_is_the_library(spark, library):
    encode, tokenizer = library
    real = [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    texts = ODD + real
    got = {r.doc_id: r for r in bpe.encode_documents(docs_of(spark, texts), vocabulary()).collect()}
    assert len(got) == len(texts)
    for at, text in enumerate(texts):
        ids = encode(text)
        assert got[at].ids == ids, repr(text)[:80]
        assert got[at].decoded == tokenizer.decode(ids, skip_special_tokens=False)


def test_chunks_are_shared_and_joined(library):
    encode, _ = library
    passage = " ".join(f"word{i} thing{i * 7}" for i in range(2000))
    chunks = bpe.ChunkEncoder(vocabulary())
    for text in [passage, "different start " + passage, passage.replace("word900", "changed"), "é" * 9000]:
        ids = [int.from_bytes(found, "little") for found in
               (lambda b: [b[i:i + 4] for i in range(0, len(b), 4)])(chunks.encode(text))]
        assert ids == encode(text)
    assert chunks.reused > chunks.encoded


def test_bpe_empty(spark):
    assert bpe.encode_documents(docs_of(spark, ["x"]).limit(0), vocabulary()).count() == 0


@pytest.mark.parametrize("capacity", [64, 4096])
def test_packing_holds_each_id_once(spark, library, capacity):
    encode, _ = library
    texts = ODD + [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60).collect()]
    pieces = packing.pack_documents(docs_of(spark, texts), vocabulary(), capacity=capacity).collect()
    by_doc, by_sequence = {}, {}
    for piece in pieces:
        by_doc.setdefault(piece.doc_id, []).append(piece)
        by_sequence.setdefault(piece.sequence_id, []).append(piece)
    for at, text in enumerate(texts):
        ids, place = encode(text) + [2], 0
        for piece in sorted(by_doc[at], key=lambda piece: piece.start):
            part = b"".join(i.to_bytes(4, "little") for i in ids[piece.start:piece.start + piece.length])
            assert piece.start == place and zlib.crc32(piece.ids) == zlib.crc32(part) and piece.doc_tokens == len(ids)
            place += piece.length
        assert place == len(ids)
    for parts in by_sequence.values():
        place = 0
        for piece in sorted(parts, key=lambda piece: piece.offset):
            assert piece.offset == place
            place += piece.length
        assert place <= capacity
    lengths = [sum(piece.length for piece in parts) for parts in by_sequence.values()]
    padding = sum(capacity - length for length in lengths if length & length - 1)
    assert padding <= 0.05 * sum(lengths)


def test_differencing():
    sizes = [8, 7, 6, 5, 4]
    lists = packing.difference(sizes, 2)
    assert sorted(sum(sizes[i] for i in part) for part in lists) == [14, 16]
    assert sorted(i for part in lists for i in part) == list(range(5))
    windows = packing.pack_parts([6, 6, 6], 10)  # two windows would hold 18, but not these
    assert sorted(map(len, windows)) == [1, 1, 1]
    assert packing.difference([], 3) == []


# Sharding


def test_shards(spark):
    texts = ["é" * (i * 37 % 400) for i in range(300)] + [None, "", "same", "same"]
    rows = [(i * 7 % 301 if i < 303 else 5, text) for i, text in enumerate(texts)] + [(None, "n" * 50)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = sharding.contiguous_shards(frame, 8).collect()
    order = sorted(((doc is not None, doc or 0, len((text or "").encode()) + 1, zlib.crc32((text or "").encode()))
                    for doc, text in rows))
    total, before, slots, want = sum(row[2] for row in order), 0, Counter(), []
    for known, doc, size, crc in order:
        shard = min(7, (2 * before + size) * 8 // (2 * total))
        want.append((doc if known else None, size, crc, shard, slots[shard]))
        slots[shard] += 1
        before += size
    key = lambda row: (row[0] is not None, row[0] or 0, *row[1:])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert sharding.contiguous_shards(frame.limit(0)).count() == 0
