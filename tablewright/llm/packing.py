"""Harmonic packing of token sequences.

Whole sequences are cut from the beginning of a document that is longer than the capacity; what is left is put
into the class of its length: class k < ``CLASSES`` takes lengths in (capacity / (k + 1), capacity / k], the last
class all shorter ones.  A bin of class k takes k of them uncut, so it is more than k / (k + 1) full; the next
piece of that class gives its beginning to what is still free, which closes the bin without padding, and the rest of that piece
goes on in the class of its own length.  So a bin costs one cut, whatever it holds.  (A bin of the last class
takes pieces as long as they fit.)

Each worker fills the bins of every class on its own, from its own documents only: no shuffle, no order
between workers.  It holds at most one open bin for each class.  What lies in those at the end is laid end to end
and cut into whole sequences, and the last, shorter one by the binary digits of its length: sequences at a power
of two need no padding.  No sequence is padded at all; a worker leaves at most one short sequence for each digit.

Defined results: null and empty texts are one piece, the end id alone; documents with equal ids are packed one
by one; other columns are ignored.  Sequence ids are the partition's number times 2**40 plus a count, so a
task that runs again gives the same rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from . import bpe
from ._spark import two_columns

NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
SCHEMA = ", ".join(f"{n} long" for n in NAMES)
#: Rows of one Arrow batch that goes back to Spark.
ROWS = 20_000
#: The last class takes all that is shorter than the others' lengths.
CLASSES = 64


class Bins:
    """The open bins of one worker.  A piece is its document's id, tokens before it, ids as bytes, the document's tokens."""

    def __init__(self, capacity: int, first: int) -> None:
        self.capacity, self.next, self.done = capacity, first, []
        self.open: dict[int, tuple[list[tuple], int]] = {}

    def add(self, key: int | None, ids: bytes) -> None:
        """Pack a document."""
        n, capacity = len(ids) // 4, self.capacity
        whole = n - n % capacity
        for at in range(0, whole, capacity):
            self._close([(key, at, ids[4 * at : 4 * (at + capacity)], n)])
        if n > whole:
            self._place((key, whole, ids[4 * whole :] if whole else ids, n))

    def _place(self, piece: tuple) -> None:
        while True:
            key, at, ids, n = piece
            length = len(ids) // 4
            k = min(self.capacity // length, CLASSES)
            held, room = self.open.get(k, ([], self.capacity))
            # a bin short of its class's count has room for one more; one with them all has less than any piece of the class
            taken = min(length, room)
            held.append(piece if taken == length else (key, at, ids[: 4 * taken], n))
            if taken == room:
                self._close(held)
                self.open.pop(k, None)
            else:
                self.open[k] = held, room - taken
            if taken == length:
                return
            piece = key, at + taken, ids[4 * taken :], n

    def _close(self, pieces: list[tuple]) -> None:
        offset = 0
        for key, at, ids, n in pieces:
            length = len(ids) // 4
            self.done.append((key, at, length, zlib.crc32(ids), n, self.next, offset))
            offset += length
        self.next += 1

    def finish(self) -> None:
        """Lay the open bins end to end and cut them anew."""
        left = [p for k in sorted(self.open) for p in self.open[k][0]]
        total = sum(len(p[2]) // 4 for p in left)
        sizes = [self.capacity] * (total // self.capacity) + [1 << b for b in reversed(range(self.capacity.bit_length() - 1)) if total % self.capacity >> b & 1]
        left.reverse()
        for size in sizes:
            held = []
            while size:
                key, at, ids, n = left.pop()
                if len(ids) > 4 * size:
                    left.append((key, at + size, ids[4 * size :], n))
                    ids = ids[: 4 * size]
                held.append((key, at, ids, n))
                size -= len(ids) // 4
            self._close(held)
        self.open = {}


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = 2048, end_id: int = 1, path: str | None = None) -> DataFrame:
    """A row for each piece: where it lies in its document and in which sequence, and the checksum of its ids."""
    if capacity & (capacity - 1):
        raise ValueError("the capacity must be a power of two")
    shared = docs.sparkSession.sparkContext.broadcast(bpe.default_source(path))
    last = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode: Callable[[bytes], bytes] = bpe.coder(shared.value, True).encode
        bins = Bins(capacity, TaskContext.get().partitionId() << 40)
        for batch in batches:
            for k, t in bpe.texts_of(batch):
                bins.add(k, encode(t) + last)
                if len(bins.done) >= ROWS:
                    yield _rows(bins)
        bins.finish()
        if bins.done:
            yield _rows(bins)

    return two_columns(docs, key, text).mapInArrow(run, SCHEMA)


def _rows(bins: Bins) -> pa.RecordBatch:
    columns, bins.done = list(zip(*bins.done, strict=True)), []
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], NAMES)


def op5_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
