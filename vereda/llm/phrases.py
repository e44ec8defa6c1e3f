"""Phrase collocations by dynamic itemset counting over shards of the corpus.

The corpus is written once in ``SHARDS`` shards, which are scanned in a cycle. All words are
counted from the first scan on. A longer phrase becomes active at the first scan boundary where
its two parts, without the last and without the first word, have reached the threshold; it is
counted in the scans from there on, whatever lengths are counted beside it, until it has seen
every shard once. The work ends when no phrase is active.

What is active is told by a table of ``2^SLOT_BITS`` bytes, the only thing that is broadcast: a
phrase's slot holds the boundary at which the first phrase of that slot reached the threshold.
It is never changed afterwards, so every phrase is counted for exactly one cycle. A slot that
two phrases share makes some phrases active that need not be, never the other way round.

A phrase that reaches the threshold in all shards together reaches a shard's share of it in one
of them. So only phrases with such a scan, and few that share a slot with one, are summed over
the scans; the others, nearly all, are written once and not shuffled again.

Phrases are told apart by 61 bits of their words' hashes, and the length; the words themselves
are read at the end, for candidates only, from as much of the corpus as names them all.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from vereda.llm.common import text_of
from vereda.llm.rolling import BASE, powers
from vereda.session import new_folder, park

LONGEST = 5
FEWEST = 100
BEST = 2000
DEALS = 256
SHARDS = 3
SLOT_BITS = 22
SLAB = 1 << 20  # bytes of text looked at together
HELD = 4 << 20  # phrase occurrences a task holds before it counts them
NEVER = 255
#: floor(1000 a n / (l r)), exact in 38 digits.
SCORE = "".join((
    "1000BD * CAST({a} AS DECIMAL(17, 0)) * CAST({n} AS DECIMAL(17, 0)) ",
    "div (CAST({l} AS DECIMAL(17, 0)) * CAST({r} AS DECIMAL(17, 0)))",
))
_STOP = b".,;:!?\n\x0b\x0c\r"
_BLANK = b" \t"
_KIND = np.zeros(256, np.uint8)
_KIND[list(_BLANK)] = 1
_KIND[list(_STOP)] = 2
_SAME = bytes(32 if kind else at for at, kind in enumerate(_KIND.tolist()))
_TAIL = re.compile(rb"(?:[ \t.,;:!?\n-\r]*[^ \t.,;:!?\n-\r]+){0,%d}" % (LONGEST - 1))
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_TURN = np.uint64(0x94D049BB133111EB)


def _mixed(values):
    values = (values ^ values >> np.uint64(30)) * _MIX
    values = (values ^ values >> np.uint64(27)) * _TURN
    return values ^ values >> np.uint64(31)


def _parts(text, slab=SLAB):
    """Parts of a text, each with the next words behind it, and the length of the part alone.

    A part ends at a blank or stop, so no word is cut; phrases that begin in a part end in the
    words behind it.
    """
    if len(text) <= slab:
        yield text, len(text)
        return
    plain, at = text.translate(_SAME), 0
    while at < len(text):
        end = len(text)
        if end - at > slab:
            end = plain.rfind(b" ", at, at + slab) + 1
            if end <= at:
                end = plain.find(b" ", at + slab) + 1 or len(text)
        yield text[at:_TAIL.match(text, end).end()], end - at
        at = end


def _slabs(batch):
    """Texts laid end to end, a stop between: bytes, begin of each, begin of what is behind
    each part, and language number; then the languages."""
    names = [name.as_py() for name in batch["lang"]]
    kinds = sorted(set(names))
    number = {name: at for at, name in enumerate(kinds)}
    held, begins, ends, langs, size = [], [], [], [], 0
    for name, text in zip(names, batch["text"].cast(pa.binary())):
        for part, own in _parts(text.as_py()):
            held.append(part.lower())
            begins.append(size)
            ends.append(size + own)
            langs.append(number[name])
            size += len(part) + 1
            if size >= SLAB:
                yield b"\n".join(held), np.array(begins), np.array(ends), np.array(langs), kinds
                held, begins, ends, langs, size = [], [], [], [], 0
    if held:
        yield b"\n".join(held), np.array(begins), np.array(ends), np.array(langs), kinds


def _seed(name):
    """A number for a language, from its name."""
    value = np.frombuffer(name.encode("utf-8").ljust(8, b"\0")[:8], np.uint64)[0]
    return _mixed(np.array([value + np.uint64(sum(name.encode("utf-8")) * 977 + len(name))]))[0]


class Words:
    """The words of a slab in order: where they begin and end, their hashes and neighbours."""

    def __init__(self, data, begins, ends, langs, kinds):
        values = np.frombuffer(data, np.uint8)
        kind = _KIND[values]
        inside = np.r_[False, kind == 0, False]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.data, self.begin, self.end = data, edges[::2], edges[1::2]
        up, down = powers(len(values) + 1)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
        hashes = _mixed((sums[self.end] - sums[self.begin]) * down[self.begin])
        text = np.searchsorted(begins, self.begin, side="right") - 1
        self.lang = langs[text]
        self.seed = np.array([_seed(name) for name in kinds], np.uint64)[self.lang]
        self.own = self.begin < ends[text]  # not of the words behind a part
        stops = np.cumsum(kind == 2)
        piece = stops[self.begin] if len(values) else np.zeros(0, np.int64)
        # Words in a row from each on, itself included, within its piece.
        last = np.searchsorted(piece, piece, side="right")
        self.room = last - np.arange(len(piece))
        self.hashes = [None, hashes]
        for length in range(2, LONGEST + 1):
            longer = self.hashes[-1][:-1] if len(self.hashes[-1]) else hashes[:0]
            following = hashes[length - 1:]
            longer = longer[:len(following)]
            self.hashes.append(longer * BASE + following)

    def keys(self, length, at):
        """Key of the phrases of a length that begin at words ``at``: hash, then length."""
        mixed = _mixed(self.hashes[length][at] ^ self.seed[at])
        return (mixed & ~np.uint64(7)) | np.uint64(length)

    def totals(self, at):
        """Key of all words of the language of the words ``at``, a phrase of length zero."""
        return _mixed(self.seed[at]) & ~np.uint64(7)

    def phrase(self, at, length):
        """The words from ``at`` on, a space between each two."""
        return b" ".join(
            self.data[a:b] for a, b in zip(
                self.begin[at:at + length].tolist(), self.end[at:at + length].tolist())
        ).decode("utf-8")


def _slot(keys, bits):
    return (keys >> np.uint64(64 - bits)).astype(np.int64)


def _other_slot(keys, bits):
    return (keys >> np.uint64(3) & np.uint64((1 << bits) - 1)).astype(np.int64)


def _active(words, slots, bits):
    """For each length the words at which a phrase begins whose parts have reached the
    threshold, its keys, and the boundary from which it is counted."""
    at = np.flatnonzero(words.own)
    yield 1, at, words.keys(1, at), np.zeros(len(at), np.uint8)
    at = np.arange(len(words.begin))
    since = slots[_slot(words.keys(1, at), bits)]
    for length in range(2, LONGEST + 1):
        reached = np.full(len(words.begin) + 1, NEVER, np.uint8)
        reached[at] = since
        at = np.flatnonzero((reached[:-1] != NEVER) & (reached[1:] != NEVER) & (words.room >= length))
        since = np.maximum(reached[at], reached[at + 1])
        keys = words.keys(length, at)
        own = words.own[at]
        yield length, at[own], keys[own], since[own]
        # A slot may be older by chance than the parts of a phrase; the phrase is not.
        since = np.maximum(slots[_slot(keys, bits)], since)


def _scan(slots, bits, turn, shards):
    def run(batches):
        table, held, size = np.frombuffer(slots.value, np.uint8), [], 0

        def out():
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))], names=["key", "n"]
            )

        for batch in batches:
            for slab in _slabs(batch):
                words = Words(*slab)
                for length, at, keys, since in _active(words, table, bits):
                    keys = keys[(since <= turn) & (turn < since.astype(np.int64) + shards)]
                    held.append(keys)
                    size += len(keys)
                if turn < shards:  # key of no words: all words of a language
                    held.append(words.totals(np.flatnonzero(words.own)))
                if size >= HELD:
                    yield out()
                    held, size = [], 0
        if size:
            yield out()

    return run


def _shards(docs, lang, text, shards):
    """The stored corpus, ``lang, text, shard``, a folder for each shard."""
    rows = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
        text_of(f"`{text}`").alias("text"),
    )
    path = new_folder(docs.sparkSession, "shards")
    number = F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int")
    rows.withColumn("shard", number).write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema("lang string, text string, shard int").parquet(path)


def _portions(corpus):
    """The stored corpus in parts: the files of one writing task, of three, of twelve and so on.

    The condition is on file names alone, so files of other portions are not opened.
    """
    task = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("bigint")
    end = 1
    while end <= 1 << 32:
        yield corpus.filter((task >= end // 4) & (task < end)).select("lang", "text")
        end *= 4


def _new_slots(keys, place):
    """The slots of ``keys`` with the least length of their phrases. At most as many rows as
    there are slots reach the driver, of eight bytes each."""
    length = F.col("key").bitwiseAND(F.lit(7)).cast("int")
    found = keys.groupBy(place.cast("int").alias("slot")).agg(F.min(length).alias("length")).toArrow()
    return found["slot"].to_numpy(), found["length"].to_numpy()


def _union(tables):
    whole = tables[0]
    for more in tables[1:]:
        whole = whole.unionByName(more)
    return whole


def _only(marked, bits):
    """The rows whose key has its slot marked."""
    def run(batches):
        table = np.frombuffer(marked.value, np.uint8)
        for batch in batches:
            keys = batch["key"].to_numpy().view(np.uint64)
            yield batch.filter(pa.array(table[_other_slot(keys, bits)] > 0))

    return run


def _reached(scans, strong, fewest, bits):
    """``key, n`` of the phrases that reach the threshold over the scans.

    Only keys in a slot of ``strong`` are summed, by a table of fixed size: a join would deal
    out all phrases of the scans again, as their number is beyond a broadcast.
    """
    several = _union(scans).mapInArrow(_only(strong, bits), "key bigint, n bigint")
    return several.groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= fewest)


def _low_slot(bits):
    return F.shiftrightunsigned("key", 3).bitwiseAND(F.lit((1 << bits) - 1))


def count_phrases(shards: list, fewest=FEWEST, bits=SLOT_BITS):
    """``key, n`` of all phrases that occur ``fewest`` times, and of all words by language.

    ``shards`` are DataFrames (lang, text), one for each shard, that read the same on every use.
    """
    spark, cycle = shards[0].sparkSession, len(shards)
    share = -(-fewest // cycle)
    slots = np.full(1 << bits, NEVER, np.uint8)
    scans, strong, turn = [], np.zeros(1 << bits, np.uint8), 0
    latest = 0  # the last boundary at which a phrase became active
    while turn < latest + cycle:
        held = spark.sparkContext.broadcast(slots.tobytes())
        found = shards[turn % cycle].mapInArrow(
            _scan(held, bits, turn, cycle), "key bigint, n bigint"
        ).groupBy("key").agg(F.sum("n").alias("n"))
        scans.append(park(found, f"scan-{turn}"))
        strong[_new_slots(scans[-1].filter(F.col("n") >= share), _low_slot(bits))[0]] = 1
        turn += 1
        held.unpersist()
        held = spark.sparkContext.broadcast(strong.tobytes())
        # What can still reach the threshold is counted in the scans of one cycle.
        phrases = _reached(scans[-cycle:], held, fewest, bits).filter(
            F.col("key").bitwiseAND(F.lit(7)) > 0
        )
        new, length = _new_slots(phrases, F.shiftrightunsigned("key", 64 - bits))
        unset = slots[new] == NEVER
        slots[new[unset]] = turn
        if (length[unset] < LONGEST).any():
            latest = turn
        held.unpersist()
    held = spark.sparkContext.broadcast(strong.tobytes())
    return park(_reached(scans, held, fewest, bits), "reached"), slots


def _names(slots, bits):
    """Candidates, once a task, and few other phrases: ``cuts`` has the keys of both parts of
    every cut, ``total`` the key of all words of the language."""
    def run(batches):
        table, wanted = (np.frombuffer(part, np.uint8) for part in slots.value)
        seen = np.zeros(0, np.uint64)
        for batch in batches:
            for slab in _slabs(batch):
                words, rows, fresh = Words(*slab), [], [seen]
                kinds = slab[-1]
                for length, at, keys, _ in _active(words, table, bits):
                    if length == 1:
                        continue
                    kept = wanted[_other_slot(keys, bits)] > 0
                    keys, one = np.unique(keys[kept], return_index=True)
                    at = at[kept][one]
                    new = ~np.isin(keys, seen, assume_unique=True)
                    keys, at = keys[new], at[new]
                    fresh.append(keys)
                    if not len(keys):
                        continue
                    totals = words.totals(at).view(np.int64).tolist()
                    cuts = [
                        (words.keys(k, at).view(np.int64).tolist(),
                         words.keys(length - k, at + k).view(np.int64).tolist())
                        for k in range(1, length)
                    ]
                    for row, (key, place) in enumerate(zip(keys.view(np.int64).tolist(), at.tolist())):
                        rows.append((
                            key, totals[row], kinds[words.lang[place]], words.phrase(place, length),
                            [{"k": k, "left": a[row], "right": b[row]}
                             for k, (a, b) in enumerate(cuts, 1)],
                        ))
                if len(seen) > HELD:  # forgetting only repeats rows
                    fresh = fresh[1:]
                seen = np.unique(np.concatenate(fresh))
                if rows:
                    key, total, lang, phrase, cuts = zip(*rows)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(key, pa.int64()), pa.array(total, pa.int64()), pa.array(lang), pa.array(phrase),
                        pa.array(cuts, pa.list_(pa.struct(
                            [("k", pa.int32()), ("left", pa.int64()), ("right", pa.int64())]))),
                    ], names=["key", "total", "lang", "phrase", "cuts"])

    return run


_NAMED = "key bigint, total bigint, lang string, phrase string, cuts array<struct<k: int, left: bigint, right: bigint>>"


def _named(corpus, longer, slots, bits):
    """``key, a`` of ``longer`` with the words, the language and the keys of the parts.

    A frequent phrase is in nearly every task of a scan. So the corpus is read in portions that
    grow, and each names only what none before it had; the work ends when all have a name.
    """
    spark, rest, found = corpus.sparkSession, longer.withColumnRenamed("n", "a"), []
    for portion in _portions(corpus):
        wanted = np.zeros(1 << bits, np.uint8)
        wanted[_new_slots(rest, _low_slot(bits))[0]] = 1
        if found and not wanted.any():
            break
        held = spark.sparkContext.broadcast((slots.tobytes(), wanted.tobytes()))
        rows = portion.mapInArrow(_names(held, bits), _NAMED).dropDuplicates(["key"])
        found.append(park(rows.join(rest, "key"), "named"))
        rest = park(rest.join(found[-1].select("key"), "key", "left_anti"), "unnamed")
        held.unpersist()
    return _union(found)


def collocations(docs: DataFrame, lang="lang", text="text", fewest=FEWEST, best=BEST,
                 shards=SHARDS, bits=SLOT_BITS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``best`` phrases by score.

    A-Z are lower-cased; stops and line ends part a text into pieces, blanks a piece into
    words. Phrases have 2 to 5 words of one piece and occur ``fewest`` times (``a``) in the
    texts of the language, a null language being ``und``. ``n`` counts the language's words,
    ``l`` and ``r`` the two parts of the cut with the lowest ``score`` = floor(1000 a n / (l r)),
    the first of equals. A phrase inside a longer one as frequent is left out. Ranks go by
    score, ``a``, then the bytes of the phrase. Null and empty texts have no words; repeated rows
    count each; very long texts are read in parts of a megabyte. Other columns are not read. An
    empty table, or one without frequent phrases, gives no rows.
    """
    corpus = _shards(docs, lang, text, shards)
    known, slots = count_phrases(
        [corpus.filter(F.col("shard") == at).select("lang", "text") for at in range(shards)], fewest, bits
    )
    named = _named(corpus, known.filter(F.col("key").bitwiseAND(F.lit(7)) > 1), slots, bits)

    length = F.col("key").bitwiseAND(F.lit(7))
    # The longest proper parts; those of equal count lie inside this phrase at every occurrence.
    inner = named.filter(length > 2).select(
        F.col("a").alias("_a"), F.explode(F.array(F.element_at("cuts", -1)["left"], F.col("cuts")[0]["right"])).alias("key")
    ).groupBy("key").agg(F.max("_a").alias("_a"))
    maximal = named.join(inner, "key", "left").filter("_a IS NULL OR _a < a").drop("_a")

    def counted(key, name):
        return known.select(F.col("key").alias(key), F.col("n").alias(name))

    cut = maximal.select("total", "key", "lang", "phrase", "a", F.inline("cuts"))
    scored = cut.join(counted("left", "l"), "left").join(counted("right", "r"), "right").join(
        counted("total", "n"), "total"
    )
    score = F.expr(SCORE.format(a="a", n="n", l="l", r="r"))
    lowest = scored.withColumn("score", score).groupBy("key", "lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("_cut")
    ).select("lang", "phrase", "a", "n", "_cut.score", "_cut.l", "_cut.r")
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # A language may hold nearly all phrases: each deal keeps its own best, so that the last
    # window has at most DEALS times best rows of it.
    deal = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(DEALS))).orderBy(*order)
    lowest = lowest.withColumn("_place", F.row_number().over(deal)).filter(F.col("_place") <= best).drop("_place")
    order = Window.partitionBy("lang").orderBy(*order)
    return lowest.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best).select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
