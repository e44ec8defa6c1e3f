"""Spelling variants: words one edit apart, found by dynamic programming over sorted lists.

The vocabulary is dealt to lists whose words can be near. One edit leaves the first or the
second half of the shorter word as it is, so each word of length m goes to the list of its
first half and to that of its second half, for m and for m - 1. A list with too many words is
dealt again: the half that may differ is halved, down to one letter, which bounds every list.
A pair is counted in the list that holds its first difference, so in one list only.

A list is sorted and scanned once for all its words as queries. A row of the edit matrix, cut to
the band of one edit around the diagonal, is computed once for the run of words that share its
prefix (as told by the longest common prefixes of neighbours) and serves all of them; a run
whose prefix is more than one edit away is skipped whole.
"""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vereda.llm.common import text_of
from vereda.session import park

RUN = re.compile("[A-Za-zÀ-ÿ]+")
SHORTEST = 5
FEWEST = 3
EVERY = 97
LIST = 20_000  # words of one list
LIST_BYTES = 32 << 20
CHUNK = 8_000  # queries looked at together
HELD = 400_000  # different words a task counts before it hands them on
SLICE = 4 << 20


def misspelt(doc_id: str, run: str, every=EVERY) -> str:
    """The run, without one code point where the checksum of document and run says so."""
    mark = zlib.crc32(f"{doc_id}:{run}".encode("utf-8", "surrogatepass"))
    if every and mark % every == 0:
        at = mark % len(run)
        return run[:at] + run[at + 1:]
    return run


def _runs(text):
    lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    if len(lowered) <= SLICE:
        return Counter(RUN.findall(lowered))
    return Counter(found.group() for found in RUN.finditer(lowered))


def _count(every, shortest):
    def run(batches):
        total = Counter()

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                names=["word", "n"],
            )

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                for word, n in _runs(text.as_py()).items():
                    word = misspelt(doc_id, word, every)
                    if len(word) >= shortest:
                        total[word] += n
                if len(total) >= HELD:
                    yield out()
                    total.clear()
        if total:
            yield out()

    return run


def vocabulary(docs: DataFrame, doc_id="doc_id", text="text", every=EVERY, shortest=SHORTEST,
               fewest=FEWEST) -> DataFrame:
    """``word, n``: words of ``shortest`` code points or more that occur ``fewest`` times."""
    rows = docs.select(
        F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("doc_id"),
        text_of(f"`{text}`").alias("text"),
    )
    counted = rows.mapInArrow(_count(every, shortest), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= fewest)


def _listed(rows):
    """``rows`` (word, n, m, lo, hi) with the list of each: what all its words have in common.

    Of the shorter word's ``m`` letters those from ``lo`` to ``hi`` may differ.
    """
    kept = F.col("m") - F.col("hi")
    return rows.withColumn("list", F.xxhash64(
        "m", "lo", "hi", F.expr("substring(word, 1, lo)"),
        F.when(kept > 0, F.expr("right(word, m - hi)")).otherwise(""),
    ))


def deal(words: DataFrame, shortest=SHORTEST, size=LIST) -> DataFrame:
    """``list, word, n, m, lo, hi``: all words in lists of bounded size."""
    length, half = F.char_length("word"), F.col("m").cast("int") / F.lit(2)
    halves = words.select("word", "n", F.explode(
        F.when(length > shortest, F.array(length, length - 1)).otherwise(F.array(length))
    ).alias("m")).withColumn("_half", F.floor(half).cast("int")).select(
        "word", "n", "m", F.inline(F.array(
            F.struct(F.lit(0).alias("lo"), F.col("_half").alias("hi")),
            F.struct(F.col("_half").alias("lo"), F.col("m").alias("hi")),
        ))
    )
    rows, done = park(_listed(halves), "lists"), []
    while True:
        counts = rows.groupBy("list").agg(
            F.count(F.lit(1)).alias("_size"), F.max("m").alias("_m"), F.max(F.col("hi") - F.col("lo")).alias("_free")
        )
        keep = F.col("_size") > 1
        large = ((F.col("_size") > size) | (F.col("_size") * F.col("_m") > LIST_BYTES)) & (F.col("_free") > 1)
        marks = park(counts.filter(keep).select("list", large.alias("_large")), "list-sizes")
        split = marks.filter("_large").limit(1).count()
        done.append(rows.join(marks.filter(~F.col("_large")).select("list"), "list", "left_semi"))
        if not split:
            break
        middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        rows = rows.join(marks.filter("_large").select("list"), "list", "left_semi").select(
            "word", "n", "m", F.inline(F.array(
                F.struct(F.col("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi")),
            ))
        )
        rows = park(_listed(rows), "lists")
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    return found


def _letters(words):
    """The words, all in Latin-1, as rows of bytes with zeros behind; their lengths."""
    coded = [word.encode("latin-1") for word in words]
    lengths = np.fromiter(map(len, coded), np.int64, len(coded))
    width = int(lengths.max(initial=0)) + 2
    data = b"".join(word.ljust(width, b"\0") for word in coded)
    return np.frombuffer(data, np.uint8).reshape(len(coded), width), lengths


def one_edit(letters, lengths, lists, queries):
    """Pairs (query, word) of rows of one list that are one edit apart.

    Rows are sorted by (list, word). Level by level of prefix length: each query holds the runs
    of words whose shared prefix is within one edit of a prefix of its own, with three cells of
    the edit matrix row for that prefix.
    """
    n = len(letters)
    same = letters[1:] == letters[:-1]
    shared = np.where(same.all(axis=1), letters.shape[1], same.argmin(axis=1))
    shared = np.r_[-1, np.where(lists[1:] == lists[:-1], shared, -1)]
    begins = np.flatnonzero(shared < 0)
    at_list = np.searchsorted(begins, queries, side="right") - 1
    query, start = queries, begins[at_list]
    end = np.r_[begins, n][at_list + 1]
    behind = np.full(len(queries), 9, np.int8)
    level = np.zeros(len(queries), np.int8)
    ahead = np.ones(len(queries), np.int8)
    left, right = [], []
    blank = np.zeros(0, np.uint8)
    for depth in range(int(lengths.max(initial=0)) + 1):
        if not len(query):
            break
        over = lengths[query] - depth
        cell = np.where(over == 0, level, np.where(over == 1, ahead, np.where(over == -1, behind, 9)))
        hit = (lengths[start] == depth) & (cell == 1)
        left.append(query[hit])
        right.append(start[hit])
        heads = np.flatnonzero(shared <= depth)
        first, last = np.searchsorted(heads, start), np.searchsorted(heads, end)
        count = last - first
        parent = np.repeat(np.arange(len(query)), count)
        child = np.arange(len(parent)) - np.repeat(np.cumsum(count) - count, count) + first[parent]
        letter = letters[heads[child], depth]
        live = letter > 0
        parent, child, letter = parent[live], child[live], letter[live]
        query = query[parent]
        own = letters[query, depth - 1] if depth else blank
        back = behind[parent] + (own != letter) if depth else behind[parent]
        new_behind = np.minimum(back, level[parent] + 1)
        new_level = np.minimum(level[parent] + (letters[query, depth] != letter), ahead[parent] + 1)
        new_level = np.minimum(new_level, new_behind + 1)
        next_own = letters[query, min(depth + 1, letters.shape[1] - 1)]
        new_ahead = np.minimum(ahead[parent] + (next_own != letter), new_level + 1)
        near = np.minimum(np.minimum(new_behind, new_level), new_ahead) <= 1
        query, child = query[near], child[near]
        start, end = heads[child], np.r_[heads, n][child + 1]
        behind, level, ahead = (x[near].astype(np.int8) for x in (new_behind, new_level, new_ahead))
    return np.concatenate(left), np.concatenate(right)


def _scan(table):
    """Near words of each word of whole lists: ``word, n_near, best_n, best``."""
    words = table["word"].to_pylist()
    letters, lengths = _letters(words)
    n, m, lo, hi = (table[name].to_numpy() for name in ("n", "m", "lo", "hi"))
    lists = table["list"].to_numpy()
    out = []
    for at in range(0, len(words), CHUNK):
        a, b = one_edit(letters, lengths, lists, np.arange(at, min(at + CHUNK, len(words))))
        same = letters[a] == letters[b]
        first = np.where(same.all(axis=1), letters.shape[1], same.argmin(axis=1))
        own = np.minimum(lengths[a], lengths[b]) == m[a]
        own &= (first < hi[a]) | (hi[a] == m[a])
        a, b = a[own], b[own]
        if not len(a):
            continue
        order = np.lexsort((b, -n[b], a))  # rows of a list are in the order of their words
        a, b = a[order], b[order]
        heads = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
        counts = np.diff(np.r_[heads, len(a)])
        out.append(pa.RecordBatch.from_arrays(
            [pa.array([words[x] for x in a[heads].tolist()]), pa.array(counts),
             pa.array(n[b[heads]]), pa.array([words[x] for x in b[heads].tolist()])],
            names=["word", "n_near", "best_n", "best"],
        ))
    return out


def _scan_lists(batches):
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= LIST:
            table = pa.Table.from_batches(held)
            lists, m = table["list"].to_numpy(), table["m"].to_numpy()
            # Lists of long and short words are taken apart, or short ones would be padded.
            new = np.flatnonzero((lists[1:] != lists[:-1])) + 1
            if not len(new):
                continue
            for part in _parts(table, m, int(new[-1])):
                yield from _scan(part)
            rest = table.slice(int(new[-1]))
            held, size = rest.to_batches(), rest.num_rows
    if size:
        table = pa.Table.from_batches(held)
        for part in _parts(table, table["m"].to_numpy(), table.num_rows):
            yield from _scan(part)


def _parts(table, m, end):
    cuts = np.r_[0, np.flatnonzero(m[1:end] != m[:end - 1]) + 1, end]
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if b - a > 1:
            yield table.slice(a, b - a)


def near_words(words: DataFrame, shortest=SHORTEST, size=LIST) -> DataFrame:
    """``word, n_near, best_n, best`` for words of ``words`` (word, n) that have near words.

    ``best`` is the near word of largest ``n``, of equals the first in code-point order.
    """
    lists = deal(words, shortest, size)
    found = (
        lists.repartition("list").sortWithinPartitions("m", "list", "word")
        .mapInArrow(_scan_lists, "word string, n_near bigint, best_n bigint, best string")
    )
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"),
        F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("_best"),
    ).select("word", "n_near", (-F.col("_best.less")).alias("best_n"), F.col("_best.best").alias("best"))


def _roots(forms):
    """``word, root`` for every word with a form: the end of its chain.

    A chain at least doubles in frequency with each step, so it is short; each round doubles
    the steps taken.
    """
    steps = park(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        steps = park(steps.join(on, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved"),
        ), "forms")
        moved = steps.filter("_moved").limit(1).count()
        steps = steps.select("word", "root")
        if not moved:
            return steps


def variant_groups(docs: DataFrame, doc_id="doc_id", text="text", every=EVERY, shortest=SHORTEST,
                   fewest=FEWEST, size=LIST) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the vocabulary.

    Words are maximal runs of Latin letters (A-Z, a-z, U+00C0 to U+00FF) with A-Z lower-cased,
    one in ``every`` of them misspelt by a rule on the document's id (0: none). A null text has
    no words, an id that is null counts as empty text; rows with equal ids and texts count like
    any others. Very long texts are read run by run, very long words have lists of fewer words.
    ``form`` is the near word of largest ``n`` (of equals the first in code-point order) if that
    is at least twice the word's, ``root`` the last of the chain of forms. Other columns are
    not read. An empty table gives no rows.
    """
    words = park(vocabulary(docs, doc_id, text, every, shortest, fewest), "vocabulary")
    near = words.join(near_words(words, shortest, size), "word", "left")
    formed = F.col("best_n") >= 2 * F.col("n")
    described = park(near.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n"),
    ), "near-words")
    roots = _roots(described.filter("form IS NOT NULL"))
    return described.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
