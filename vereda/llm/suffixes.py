"""Removal of byte strings that occur more than once, by sorting hash-compared suffixes.

A window is a string of ``length`` bytes. Every window has one anchor: the place of the
least-hashed ``GRAM`` bytes in it, the first of equals. Equal windows have equal anchors, so
only windows whose anchors' bytes occur elsewhere can repeat. Neighbouring windows mostly
share their anchor; together with the bytes they cover they make a *segment*.

1. Segments of all documents are counted by anchor bytes; those that occur once are done.
2. Segments with equal bytes are one class; in a class of two or more every byte goes.
3. Different segments around the same anchor bytes are compared. Their suffixes from the
   anchor, and their reversed prefixes before it, are sorted by mergesort. Two suffixes are
   compared by binary search for their common extension over prefix polynomial hashes, and
   the order and extensions that come out are verified on the bytes. Windows at the same
   distance before the anchor are equal when both extensions reach far enough.
4. The bytes of all repeated windows of a document are removed.

An anchor with very many segments is refined first: windows at far and near distances are
taken apart, and segments regrouped by the bytes that all their windows have, until a group
fits a task or its windows are settled by counting. No group is cut short.
"""

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from vereda.llm.common import frugal
from vereda.llm.rolling import window_hashes
from vereda.session import park

LENGTH = 400
GRAM = 64
#: Bytes of nearly every passage of over 50 words: of all runs of 51 words in the documents one in
#: a hundred has under 234 bytes, and the shortest such passage of the benchmark texts has 271.
PASSAGE = 200
LIMIT = 4000  # bytes of the longest window; a span keeps 12 bits each for windows and anchor
GROUP = 20_000  # segments of an anchor that one task compares
SLAB = 1 << 20  # bytes looked at together; a longer text is taken in overlapping slabs
_PLACE = np.uint64((1 << 24) - 1)


def _sliding_least(values, width):
    """Least of every ``width`` values in a row, by running minima of blocks."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    table = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def segments(data, ends, length=LENGTH):
    """Segments of texts laid end to end: place of the first window, windows, offset of the
    anchor in the first, and key of the anchor bytes. ``data`` is shorter than 2^24 bytes."""
    values = np.frombuffer(data, np.uint8)
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    if len(values) < length:
        return none
    hashes = window_hashes(values, GRAM)
    ranked = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    anchors = (_sliding_least(ranked, length - GRAM + 1) & _PLACE).astype(np.int64)
    inside = np.zeros(len(anchors) + 1, np.int8)
    begins = np.r_[0, ends[:-1]]
    whole = np.flatnonzero(np.asarray(ends) - begins >= length)
    inside[begins[whole]] += 1
    inside[np.asarray(ends)[whole] - length + 1] -= 1
    starts = np.flatnonzero(np.cumsum(inside[:-1]))
    if not len(starts):
        return none
    anchor = anchors[starts]
    # Texts that touch have no window across the edge, so a gap in the starts ends a segment.
    first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (np.diff(starts) != 1)])
    count = np.diff(np.r_[first, len(starts)])
    return starts[first], count, anchor[first] - starts[first], hashes[anchor[first]]


def _digests(data):
    return np.frombuffer(hashlib.blake2b(data, digest_size=16).digest(), "<i8").tolist()


def _content(data):
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def _slabs(texts, length):
    """Texts in runs of up to about ``SLAB`` bytes; long texts in overlapping parts.

    Gives (joined bytes, text numbers, offsets in the text, ends in the joined bytes).
    """
    parts, numbers, offsets, ends, size = [], [], [], [], 0
    for number, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), SLAB):
            part = text[at:at + SLAB + length - 1]
            parts.append(part)
            size += len(part)
            numbers.append(number)
            offsets.append(at)
            ends.append(size)
            if size >= SLAB:
                yield b"".join(parts), numbers, offsets, np.array(ends)
                parts, numbers, offsets, ends, size = [], [], [], [], 0
    if parts:
        yield b"".join(parts), numbers, offsets, np.array(ends)


def _texts(column):
    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]


def _emit_segments(length):
    """Rows (doc_a, doc_b, span, key, content); span packs place, windows and anchor offset."""
    def run(batches):
        for batch in batches:
            texts = _texts(batch["_text"])
            digests = [_digests(text) if len(text) >= length else (0, 0) for text in texts]
            for data, numbers, offsets, ends in _slabs(texts, length):
                at, count, anchor, key = segments(data, ends, length)
                if not len(at):
                    continue
                part = np.searchsorted(ends, at, side="right")
                place = at - np.r_[0, ends[:-1]][part] + np.array(offsets)[part]
                owner = np.array(numbers)[part]
                ids = np.array(digests, np.int64)[owner]
                content = [
                    _content(data[a:b])
                    for a, b in zip(at.tolist(), (at + count + length - 1).tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[:, 0]), pa.array(ids[:, 1]),
                     pa.array(place << 24 | count << 12 | anchor), pa.array(key.view(np.int64)),
                     pa.array(content, pa.int64())],
                    names=["doc_a", "doc_b", "span", "key", "content"],
                )

    return run


def _emit_packed(batches):
    """Rows of any columns with the text packed, and its digest."""
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        texts = _texts(batch["_text"])
        digests = [_digests(text) for text in texts]
        columns = [batch[name] for name in batch.schema.names if name != "_text"]
        names = [name for name in batch.schema.names if name != "_text"]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array([a for a, _ in digests], pa.int64()),
             pa.array([b for _, b in digests], pa.int64()),
             pa.array([pack.compress(text) for text in texts], pa.binary())],
            names=[*names, "doc_a", "doc_b", "packed"],
        )


_SEGMENT = "doc_a bigint, doc_b bigint, key bigint, content bigint, place bigint, low int, high int"


def _emit_contexts(length):
    """The bytes around the anchor of each wanted segment.

    ``place`` is the anchor's, and ``low`` to ``high`` the distances of windows before it;
    ``before`` is reversed.
    """
    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for a, b, packed, wanted in zip(*[
                batch[name].to_pylist() for name in ("doc_a", "doc_b", "packed", "wanted")
            ]):
                text = unpack.decompress(packed)
                for want in wanted:
                    span = want["span"]
                    at, count, anchor = span >> 24, span >> 12 & 4095, span & 4095
                    place, low, high = at + anchor, anchor - count + 1, anchor
                    rows.append((a, b, want["key"], want["content"], place, low, high,
                                 text[at:place][::-1], text[place:place - low + length]))
                if len(rows) > 10_000:
                    yield _context_batch(rows)
                    rows = []
            if rows:
                yield _context_batch(rows)

    return run


_CONTEXT_TYPES = [pa.int64()] * 5 + [pa.int32()] * 2 + [pa.binary()] * 2
_CONTEXT_NAMES = ["doc_a", "doc_b", "key", "content", "place", "low", "high", "before", "after"]


def _context_batch(rows):
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(zip(*rows), _CONTEXT_TYPES)],
        names=_CONTEXT_NAMES,
    )


def _words(strings, size):
    """Rows of bytes, zero-padded, as big-endian 64-bit words."""
    width = -(-size // 8) * 8
    data = b"".join(string.ljust(width, b"\0") for string in strings)
    return np.frombuffer(data, ">u8").reshape(len(strings), width // 8).astype(np.uint64)


def suffix_order(words, groups):
    """Order of the rows by (group, words), and the bytes that each shares with the one before.

    Mergesort of all groups at once. Rows are compared by binary search for the first word at
    which their prefix hashes differ. The result is verified on the words; a hash collision
    that misled the sort makes it start over by the words themselves.
    """
    n, width = words.shape
    hashes = np.zeros((n, width + 1), np.uint64)
    for at in range(width):
        hashes[:, at + 1] = hashes[:, at] * np.uint64(0x9E3779B97F4A7C15) + (
            (words[:, at] ^ words[:, at] >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
            + np.uint64(1)
        )
    padded = np.column_stack([words, np.zeros(n, np.uint64)])

    def common(x, y):
        """Words that rows share from the start."""
        low, high = np.zeros(len(x), np.int64), np.full(len(x), width, np.int64)
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = hashes[x, middle] == hashes[y, middle]
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def compare(x, y):
        """-1, 0 or 1 for each pair."""
        at = common(x, y)
        a, b = padded[x, at], padded[y, at]
        return (a > b).astype(np.int8) - (a < b).astype(np.int8)

    starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
    sizes = np.diff(np.r_[starts, n])
    start, size = np.repeat(starts, sizes), np.repeat(sizes, sizes)
    order, place = np.arange(n), np.arange(n) - start
    run = 1
    while run < size.max(initial=0):
        live = np.flatnonzero(size > run)  # places of groups that are not in order yet
        own = place[live] // run
        pair = own // 2 * 2 * run
        left = own % 2 == 0
        other = np.where(left, pair + run, pair)
        limit = np.minimum(other + run, size[live])
        low, high = np.minimum(other, limit), limit.copy()
        begin = low.copy()
        while (low < high).any():
            middle = (low + high) // 2
            open_ = low < high
            at = np.where(open_, middle, 0)
            signs = compare(order[start[live] + np.where(open_, at, place[live])], order[live])
            # A row of the left run goes before its equals of the right run.
            before = open_ & ((signs < 0) | ((signs == 0) & ~left))
            low = np.where(before, middle + 1, low)
            high = np.where(open_ & ~before, middle, high)
        rank = pair + (place[live] - own * run) + (low - begin)
        sorted_ = order.copy()
        sorted_[start[live] + rank] = order[live]
        order = sorted_
        run *= 2
    shared = np.full(n, -1, np.int64)
    same_group = np.r_[False, groups[order[1:]] == groups[order[:-1]]]

    def extensions(order):
        a, b = words[order[:-1]], words[order[1:]]
        apart = a != b
        at = np.where(apart.any(axis=1), apart.argmax(axis=1), width)
        rows = np.arange(len(at))
        full = at == width
        x = np.where(full, 0, a[rows, np.minimum(at, width - 1)])
        y = np.where(full, 0, b[rows, np.minimum(at, width - 1)])
        bits = (x ^ y).astype(np.uint64)
        zeros = np.zeros(len(at), np.int64)
        for byte in range(7):
            zeros += (bits >> np.uint64(56 - 8 * byte) == 0) & ~full
        return 8 * at + zeros, full | (x <= y)

    if n > 1:
        found, ordered = extensions(order)
        if not (ordered | ~same_group[1:]).all():
            order = np.lexsort((*words.T[::-1], groups))
            found, _ = extensions(order)
        shared[1:] = np.where(same_group[1:], found, -1)
    return order, shared


def shared_windows(groups, low, high, before, after, length=LENGTH):
    """For every segment the least and greatest distance of a window that another segment of
    its group has too, -1 if none. ``groups`` is sorted."""
    n = len(groups)
    by_after, shared_after = suffix_order(_words(after, length), groups)
    by_before, shared_before = suffix_order(_words(before, length - GRAM), groups)
    least, greatest = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    class_after, class_before = np.empty(n, np.int64), np.empty(n, np.int64)
    for distance in range(int(low.min()), int(high.max()) + 1):
        live = np.flatnonzero((low <= distance) & (distance <= high))
        if len(live) < 2:
            continue
        class_after[by_after] = np.cumsum(shared_after < length - distance)
        class_before[by_before] = np.cumsum(shared_before < distance)
        kind = class_after[live] * (n + 1) + class_before[live]
        order = np.argsort(kind, kind="stable")
        equal = kind[order[1:]] == kind[order[:-1]]
        twice = live[order[np.r_[False, equal] | np.r_[equal, False]]]
        least[twice] = np.where(least[twice] < 0, distance, least[twice])
        greatest[twice] = distance
    return least, greatest


def _compare_groups(length):
    """Byte ranges of repeated windows, from contexts that are sorted by key."""
    def run(batches):
        held, size = [], 0

        def flush(table, whole):
            keys = table["key"].to_numpy()
            if whole:
                end = len(keys)
            else:
                end = int(np.searchsorted(np.arange(len(keys)), np.flatnonzero(keys != keys[-1])[-1] + 1)) \
                    if (keys != keys[-1]).any() else 0
            out = None
            if end:
                part = table.slice(0, end)
                groups = part["key"].to_numpy()
                least, greatest = shared_windows(
                    groups, part["low"].to_numpy(), part["high"].to_numpy(),
                    part["before"].to_pylist(), part["after"].to_pylist(), length,
                )
                found = np.flatnonzero(least >= 0)
                place = part["place"].to_numpy()[found]
                out = pa.RecordBatch.from_arrays(
                    [part["doc_a"].combine_chunks().take(pa.array(found)),
                     part["doc_b"].combine_chunks().take(pa.array(found)),
                     pa.array(place - greatest[found]), pa.array(place - least[found] + length)],
                    names=["doc_a", "doc_b", "start", "end"],
                )
            return out, table.slice(end)

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= GROUP:
                out, rest = flush(pa.Table.from_batches(held), False)
                held, size = rest.to_batches(), rest.num_rows
                if out is not None and out.num_rows:
                    yield out
        if size:
            out, _ = flush(pa.Table.from_batches(held), True)
            if out is not None and out.num_rows:
                yield out

    return run


_SPANS = "doc_a bigint, doc_b bigint, start bigint, end bigint"


def _refine(part, length):
    """Each context in parts of ``part`` distances, aligned for all contexts alike, grouped
    by the bytes that all windows at the distances of a part have."""

    def run(batches):
        for batch in batches:
            rows = []
            for a, b, key, _, place, low, high, before, after in zip(*[
                batch[name].to_pylist() for name in _CONTEXT_NAMES
            ]):
                for near in range(low // part * part, high + 1, part):
                    first, last = max(low, near), min(high, near + part - 1)
                    core = before[:near][::-1] + after[:max(0, length - near - part + 1)]
                    left, right = before[:last], after[:length - first]
                    rows.append((
                        a, b, _content(b"%d %d %d " % (key, part, near) + core),
                        _content(b"%d %d " % (first, last) + left[::-1] + right),
                        place, first, last, left, right,
                    ))
            if rows:
                yield _context_batch(rows)

    return run


def _settle(contexts, group, length):
    """Spans of repeated windows among contexts, however many share a key."""
    contexts = park(contexts, "contexts")
    spans, part = [], 1 << (length - GRAM).bit_length()
    while True:
        sizes = contexts.groupBy("key").agg(F.count(F.lit(1)).alias("_size"))
        large = park(sizes.filter(F.col("_size") > group).select("key"), "large-keys")
        crowded = large.limit(1).count()
        small = contexts.join(large, "key", "left_anti") if crowded else contexts
        spans.append(
            small.repartition("key").sortWithinPartitions("key").mapInArrow(
                frugal(_compare_groups(length)), _SPANS
            )
        )
        if not crowded:
            break
        part //= 2  # at 1 a part is one window, and counting settles all of them
        parts = park(
            contexts.join(large, "key", "left_semi").select(*_CONTEXT_NAMES)
            .mapInArrow(_refine(part, length), contexts.select(*_CONTEXT_NAMES).schema), "parts",
        )
        classes = parts.groupBy("key", "content").agg(
            F.count(F.lit(1)).alias("_copies"), F.min(F.struct("doc_a", "doc_b", "place")).alias("_one")
        )
        several = classes.groupBy("key").agg(F.count(F.lit(1)).alias("_kinds")).filter("_kinds > 1")
        repeated = classes.filter("_copies > 1").select("key", "content")
        spans.append(
            parts.join(repeated, ["key", "content"], "left_semi").select(
                "doc_a", "doc_b", (F.col("place") - F.col("high")).alias("start"),
                (F.col("place") - F.col("low") + length).cast("bigint").alias("end"),
            )
        )
        one = classes.join(several, "key", "left_semi").select(
            "key", "content", F.col("_one.doc_a").alias("doc_a"),
            F.col("_one.doc_b").alias("doc_b"), F.col("_one.place").alias("place"),
        )
        contexts = park(
            parts.join(one, ["key", "content", "doc_a", "doc_b", "place"], "left_semi"), "contexts"
        )
    found = spans[0]
    for more in spans[1:]:
        found = found.unionByName(more)
    return found


def repeated_spans(rows: DataFrame, packed: DataFrame, group=GROUP, length=LENGTH) -> DataFrame:
    """``doc_a, doc_b, start, end``: byte ranges of repeated windows, by digest of the text."""
    if not GRAM < length <= LIMIT:
        raise ValueError(f"length of {length} bytes is not between {GRAM + 1} and {LIMIT}")
    found = park(rows.select("_text").mapInArrow(
        frugal(_emit_segments(length)), "doc_a bigint, doc_b bigint, span bigint, key bigint, content bigint"
    ), "segments")
    # Stored, so that the join below deals both sides anew and can split a frequent key.
    keys = park(found.groupBy("key").agg(
        F.count(F.lit(1)).alias("_rows"), (F.min("content") != F.max("content")).alias("several")
    ).filter("_rows > 1").select("key", "several"), "shared-keys")
    shared = park(found.join(keys, "key"), "shared")
    classes = park(shared.groupBy("key", "content").agg(
        F.count(F.lit(1)).alias("_copies"), F.first("several").alias("several"),
        F.min(F.struct("doc_a", "doc_b", "span")).alias("_one"),
    ), "segment-classes")

    at, count = F.shiftright("span", 24), F.shiftright("span", 12).bitwiseAND(F.lit(4095))
    copied = shared.join(
        classes.filter("_copies > 1").select("key", "content"), ["key", "content"], "left_semi"
    ).select("doc_a", "doc_b", at.alias("start"), (at + count + F.lit(length - 1)).alias("end"))

    # A text has bounded segments, so its list of them is bounded too.
    wanted = classes.filter("several").groupBy("_one.doc_a", "_one.doc_b").agg(
        F.collect_list(F.struct("key", "content", F.col("_one.span").alias("span"))).alias("wanted")
    )
    texts = packed.select("doc_a", "doc_b", "packed").join(wanted, ["doc_a", "doc_b"])
    contexts = texts.dropDuplicates(["doc_a", "doc_b"]).mapInArrow(
        frugal(_emit_contexts(length)), _SEGMENT + ", before binary, after binary"
    )
    return copied.unionByName(_settle(contexts, group, length))


def _merged(spans):
    """Maximal runs of byte ranges that touch or overlap."""
    runs = []
    for start, end in sorted((s["start"], s["end"]) for s in spans or ()):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end])
    return runs


def _emit_kept(as_text):
    def joined(pieces):
        if as_text:  # of a character that is cut, nothing stays
            return "".join(piece.decode("utf-8", "ignore") for piece in pieces)
        return b"".join(pieces)

    kind = pa.string() if as_text else pa.binary()

    def run(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for packed, spans, noted in zip(*[
                batch[name].to_pylist() for name in ("packed", "spans", "noted")
            ]):
                text, runs = unpack.decompress(packed), _merged(spans)
                cuts = [0, *(at for run in runs for at in run), len(text)]
                kept = joined([text[a:b] for a, b in zip(cuts[::2], cuts[1::2])])
                out.append((
                    len(text), sum(end - start for start, end in runs), len(runs),
                    sum(end - start for start, end in _merged(noted)), kept,
                ))
            if out:
                cells = [
                    pa.array(column, field)
                    for column, field in zip(zip(*out), [pa.int64()] * 4 + [kind])
                ]
                yield pa.RecordBatch.from_arrays([batch["_doc"], *cells], names=["_doc", *_COUNTS, "kept"])

    return run


_COUNTS = ("n_bytes", "n_removed", "n_spans", "n_noted")


def remove_repeats(docs: DataFrame, carry=None, text="text", group=GROUP, as_text=False,
                   length=LENGTH, note=None) -> DataFrame:
    """``_doc, n_bytes, n_removed, n_spans, n_noted, kept`` for every row of ``docs``.

    ``kept`` is the text's UTF-8 bytes without those covered by a string of ``length`` bytes
    that also starts anywhere else, in this or another row; overlaps count, and strings are
    judged on the texts as given. With ``as_text`` it is a string, without the characters that
    a removal cuts. ``n_spans`` counts the maximal removed runs. ``n_noted`` counts the bytes that
    such strings of ``note`` bytes cover, and these stay; without ``note`` it is ``n_removed``.
    ``_doc`` has the columns ``carry``, all but the text by default. A null text is empty;
    shorter texts stay whole; of repeated rows of that length nothing is left. A very long text
    is searched in slabs and rebuilt by one task. An empty table gives no rows.
    """
    names = [name for name in docs.columns if name != text] if carry is None else carry
    rows = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in names]).alias("_doc"), F.col(f"`{text}`").alias("_text")
    )
    fields = rows.select(
        "_doc", F.lit(0).cast("bigint").alias("doc_a"), F.lit(0).cast("bigint").alias("doc_b"),
        F.lit(b"").alias("packed"),
    ).schema
    packed = rows.mapInArrow(frugal(_emit_packed), fields)
    texts = packed.select("doc_a", "doc_b", "packed")
    found = repeated_spans(rows, texts, group, length).withColumn("removed", F.lit(True))
    if note is not None:
        # Stored, and the other length after it, so that two sets of large tables are not made at once.
        found = park(found, "spans").unionByName(
            repeated_spans(rows, texts, group, note).withColumn("removed", F.lit(False))
        )
    span = F.struct("start", "end")
    spans = F.collect_set(F.when(F.col("removed"), span))
    noted = spans if note is None else F.collect_set(F.when(~F.col("removed"), span))
    spans = found.groupBy("doc_a", "doc_b").agg(spans.alias("spans"), noted.alias("noted"))
    joined = packed.join(spans, ["doc_a", "doc_b"], "left").select("_doc", "packed", "spans", "noted")
    result = rows.select(
        "_doc", *[F.lit(0).cast("bigint").alias(name) for name in _COUNTS],
        F.lit("" if as_text else b"").alias("kept"),
    ).schema
    return joined.mapInArrow(frugal(_emit_kept(as_text)), result)
