"""BPE encoding and decoding with content-defined chunks that documents share.

A rolling hash of the last bytes cuts texts at places that depend on the content alone, so a
passage that many documents hold falls into the same chunks in all of them, and a worker
encodes each chunk once. Where two chunks meet, the words at the cut are encoded again as one
stretch between blanks. The join stands only if the ids of both sides agree with the chunks'
own up to that stretch; if not, or if a chunk has no blank, the stretch grows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vereda.llm.common import text_of
from vereda.llm.rolling import window_hashes
from vereda.llm.tokens import encoder

WINDOW = 16  # bytes the rolling hash looks back
SPACING = 1024  # bytes between cuts on average, beyond the least
LEAST = 256  # bytes between cuts
KEPT_BYTES = 32 << 20  # chunks kept per worker
_BLANKS = b" \t\n\r"

def cuts(data: bytes):
    """Offsets at which a text is cut, its ends not included."""
    n = len(data)
    if n < 2 * LEAST:
        return []
    values = np.frombuffer(data, np.uint8)
    wanted = np.flatnonzero(window_hashes(values, WINDOW) % np.uint64(SPACING) == 0)
    out, last = [], 0
    for place in (wanted + WINDOW).tolist():
        while place < n and values[place] & 0xC0 == 0x80:  # inside a character
            place += 1
        if place - last >= LEAST and n - place >= LEAST:
            out.append(place)
            last = place
    return out


class ChunkEncoder:
    """Encodes texts chunk by chunk, with the ids of recent chunks at hand."""

    def __init__(self, path, kept=KEPT_BYTES):
        self.words = encoder(path)
        self.kept, self.held, self.chunks = kept, 0, {}
        self.encoded = self.reused = self.widened = 0

    def chunk(self, data: bytes) -> bytes:
        ids = self.chunks.get(data)
        if ids is None:
            self.encoded += 1
            ids = self.words.encode(data.decode("utf-8", "surrogatepass"))
            if self.held > self.kept:
                self.chunks.clear()
                self.held = 0
            self.chunks[data] = ids
            self.held += len(data) + len(ids)
        else:
            self.reused += 1
        return ids

    def _again(self, data: bytes) -> bytes:
        return self.words.encode(data.decode("utf-8", "surrogatepass"))

    def encode(self, text: str) -> bytes:
        """Ids of a whole text."""
        data = text.encode("utf-8", "surrogatepass")
        ends = [*cuts(data), len(data)]
        out, start, stretch_from = [], 0, 0  # the last blank before ``start`` is before stretch_from
        for end in ends:
            ids = self.chunk(data[start:end])
            first = next((at for at in range(start, end) if data[at] in _BLANKS), None)
            if start == 0:
                out.append(ids)
            else:
                self._join(out, data, stretch_from, start, end, first, ids)
            last = max(data.rfind(blank, start, end) for blank in (b" ", b"\t", b"\n", b"\r"))
            stretch_from = last + 1 if last >= 0 else stretch_from
            start = end
        return b"".join(out)

    def _join(self, out, data, stretch_from, cut, end, first, ids):
        """Append a chunk's ids to those so far, with the stretch around the cut encoded anew."""
        tail = self._again(data[stretch_from:cut])
        if first is None:  # no blank in the chunk: the stretch takes all of it
            head, middle, rest = ids, self._again(data[stretch_from:end]), b""
        else:
            head = self._again(data[cut:first])
            middle, rest = self._again(data[stretch_from:first]), ids[len(head):]
        before = out.pop()
        while out and len(before) < len(tail):
            before = out.pop() + before
        agrees = before.endswith(tail) and ids.startswith(head)
        if agrees:
            out.append(before[:len(before) - len(tail)] + middle)
            out.append(rest)
        else:  # the sides do not agree: all up to here is encoded again
            self.widened += 1
            out[:] = [self._again(data[:end])]


def encode_documents(docs: DataFrame, path: str, doc_id="doc_id", text="text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, ids`` (array of int) and ``decoded``.

    The ids are those of the tokenizers library for the whole text without special tokens
    added, and ``decoded`` its decoding of them with special tokens shown. Null or blank texts
    give no ids and an empty text. Nothing is moved between tasks: a worker encodes a chunk
    once for all documents it reads. An empty table gives no rows. Other columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches):
        chunks = _chunk_encoder(path)
        for batch in batches:
            # Long texts leave in small batches.
            texts, at = batch["text"], 0
            while at < batch.num_rows:
                ids, shown, size, start = [], [], 0, at
                while at < batch.num_rows and size < 1 << 23:
                    found = np.frombuffer(chunks.encode(texts[at].as_py()), "<u4")
                    ids.append(found)
                    shown.append(chunks.words.decode(found.tolist()))
                    size += len(shown[-1])
                    at += 1
                offsets = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                flat = np.concatenate(ids).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(start, at - start),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                     pa.array(shown, pa.string())],
                    names=["doc_id", "ids", "decoded"],
                )

    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


_chunk_encoders = {}


def _chunk_encoder(path):
    if path not in _chunk_encoders:
        _chunk_encoders[path] = ChunkEncoder(path)
    return _chunk_encoders[path]
