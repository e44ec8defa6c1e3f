"""Packing into sequences of equal capacity by Karmarkar-Karp multiway differencing.

A document's full windows are sequences of their own. What is left of it is cut into parts of
a quarter window at most. Parts that fill a number of windows but for a few ids are spread
over them by largest differencing: partial partitions, each a list of window sums, are merged
largest spread first, the fullest window of one with the emptiest of the other, until one is
left. If its fullest window is over capacity, fewer ids are tried, and at last one window
more. The last ids of a task, less than a window or little more, go into sequences whose
lengths are powers of two, which need no padding.
"""

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from vereda.llm.common import text_of
from vereda.llm.tokens import encoder

CAPACITY = 4096
WINDOWS = 64  # windows of a batch
OUTPUT = 4 << 20  # bytes of ids that leave a task together
END = 2


def difference(sizes, windows):
    """Partition ``sizes`` into ``windows`` near-equal lists of item numbers."""
    # A partial partition is its windows from fullest to emptiest: (sum, items), items as
    # nested pairs so that merging does not copy them.
    heap = []
    for item, size in enumerate(sizes):
        sums = [size] + [0] * (windows - 1)
        heap.append((-size, item, sums, [item] + [None] * (windows - 1)))
    heapq.heapify(heap)
    count = len(sizes)
    while len(heap) > 1:
        _, _, sums_a, items_a = heapq.heappop(heap)
        _, _, sums_b, items_b = heapq.heappop(heap)
        merged = sorted(
            (
                (a + b, x if y is None else y if x is None else (x, y))
                for a, b, x, y in zip(sums_a, reversed(sums_b), items_a, reversed(items_b))
            ),
            key=lambda pair: -pair[0],
        )
        sums = [total for total, _ in merged]
        heapq.heappush(heap, (sums[-1] - sums[0], count, sums, [items for _, items in merged]))
        count += 1
    out = []
    for items in heap[0][3] if heap else []:
        found, left = [], [items]
        while left:
            part = left.pop()
            if isinstance(part, tuple):
                left.extend(part)
            elif part is not None:
                found.append(part)
        out.append(sorted(found))
    return out


def pack_parts(sizes, capacity=CAPACITY):
    """Lists of item numbers, none over capacity; the number of windows rises until so."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        lists = difference(sizes, windows)
        if max((sum(sizes[item] for item in items) for items in lists), default=0) <= capacity:
            return [items for items in lists if items]
        windows += 1


def take(parts, size):
    """The first ``size`` ids of a list of parts, cutting one if need be, and the others."""
    at = 0
    while at < len(parts) and size >= parts[at][2]:
        size -= parts[at][2]
        at += 1
    if not size or at == len(parts):
        return parts[:at], parts[at:]
    doc, start, length, ids, tokens = parts[at]
    head = (doc, start, size, ids[:4 * size], tokens)
    tail = (doc, start + size, length - size, ids[4 * size:], tokens)
    return [*parts[:at], head], [tail, *parts[at + 1:]]


def fill(parts, windows, capacity=CAPACITY):
    """Lists of parts that nearly fill ``windows`` windows, and the parts left over."""
    for spare in (0,) if windows == 1 else (1, 8, 64, 256):
        chosen, rest = take(parts, windows * (capacity - spare))
        sizes = [part[2] for part in chosen]
        lists = difference(sizes, windows)
        if max(sum(sizes[item] for item in items) for items in lists) <= capacity:
            break
    else:
        lists = pack_parts(sizes, capacity)
    return [[chosen[item] for item in items] for items in lists if items], rest


def cut_rest(start, length, part):
    """Near-equal cuts of a rest as (start, length)."""
    pieces = -(-length // part)
    edges = [start + length * k // pieces for k in range(pieces + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def pack_documents(docs: DataFrame, path: str, doc_id="doc_id", text="text",
                   capacity=CAPACITY, windows=WINDOWS, end=END) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    A document is the ids of its text, by the tokenizer file and without special tokens
    added, and the ``end`` id; a null text is that id alone. ``ids`` holds a piece's ids as
    little-endian unsigned 32-bit bytes. Sequences are numbered by task and order within it,
    and hold ``capacity`` ids at most. Repeated rows are packed each. An empty table gives no
    rows. Other columns are not read.

    Tasks pack what they read, a batch of some ``windows`` windows at a time, so nothing moves
    between them and memory is bounded by the longest document. A sequence depends on the file
    layout; store the result before using it twice.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    schema = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def run(batches):
        words, ending = encoder(path), np.array([end], "<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 40
        waiting, size = [], 0  # parts: doc, start, length, bytes, tokens of the document
        done, held = [], 0

        def place(parts):
            nonlocal sequence, held
            offset = 0
            for doc, start, length, ids, tokens in parts:
                done.append((doc, start, length, ids, tokens, sequence, offset))
                offset += length
                held += len(ids)
            sequence += 1

        def settle(last):
            nonlocal waiting, size
            if size >= capacity:
                lists, waiting = fill(waiting, size // capacity, capacity)
                for parts in lists:
                    place(parts)
            size = sum(part[2] for part in waiting)
            while last and size:
                length = min(capacity, 1 << size.bit_length() - 1)
                parts, waiting = take(waiting, length)
                place(parts)
                size -= length

        def output():
            nonlocal held
            columns = list(zip(*done))
            done.clear()
            held = 0
            kinds = [doc_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(column, field) for column, field in zip(columns, kinds)], names=schema
            )

        doc_type = pa.int64()
        for batch in batches:
            doc_type = batch["doc_id"].type
            for doc, body in zip(batch["doc_id"].to_pylist(), batch["text"]):
                ids = words.encode(body.as_py()) + ending
                tokens = len(ids) // 4
                full = tokens - tokens % capacity
                for start in range(0, full, capacity):
                    place([(doc, start, capacity, ids[4 * start:4 * (start + capacity)], tokens)])
                if tokens > full:
                    for start, length in cut_rest(full, tokens - full, max(1, capacity // 4)):
                        waiting.append((doc, start, length, ids[4 * start:4 * (start + length)], tokens))
                    size += tokens - full
                if size >= windows * capacity:
                    settle(False)
                if held >= OUTPUT:
                    yield output()
        settle(True)
        if done:
            yield output()

    return rows.mapInArrow(
        run, f"doc_id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, "
        "sequence_id bigint, offset bigint",
    )
