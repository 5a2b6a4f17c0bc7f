"""Best-fit packing of tokenized documents (operator 5).

Each document's ids end with the end-of-document id; only documents longer than a
sequence are cut.  Full pieces are sequences of their own.  The others are packed by
*bounded-space online best-fit*: pieces come in a stream; each goes into the open bin with
the least free space that still holds it, found in a bitset keyed by free space; when all
``OPEN_BINS`` bins are open and another is needed, the fullest is closed.

Streams are independent, so packing scales with the pieces: the piece table (some 60 bytes
a document) is dealt into streams of about ``STREAM`` pieces each.  A stream leaves at most
its open bins part-filled.

Null and empty texts give one piece that holds only the end id.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import STEP, encoder, vocabulary
from .common import bounded_batches, save, steps, table

CAPACITY = 2048
END_ID = 0
OPEN_BINS = 4096
#: Pieces of one stream.
STREAM = 100_000

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class BestFit:
    """Bounded-space online best-fit.  ``put`` returns (bin, offset)."""

    def __init__(self, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> None:
        self.capacity, self.most = capacity, open_bins
        self.free_bits = 0  # bit f: some open bin has f free places
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.n_open = self.n_bins = 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        b = bins.pop()
        if not bins:
            self.free_bits &= ~(1 << free)
        return b

    def put(self, length: int) -> tuple[int, int]:
        fits = self.free_bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            b = self._take(free)
        else:
            if self.n_open >= self.most:
                fullest = (self.free_bits & -self.free_bits).bit_length() - 1
                self._take(fullest)
                self.n_open -= 1
            b, free = self.n_bins, self.capacity
            self.n_bins += 1
            self.n_open += 1
        left = free - length
        if left:
            self.by_free[left].append(b)
            self.free_bits |= 1 << left
        else:
            self.n_open -= 1
        return b, self.capacity - free


def cut(docs: DataFrame, vocab_path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The pieces of each document, with the CRC-32 of their ids."""
    vocab = docs.sparkSession.sparkContext.broadcast(vocabulary(vocab_path))
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocab.value)
        for step in steps(batches, "text", STEP, owner="bpe"):
            ids, at = enc.encode(step.column("text"))
            n = len(at) - 1
            sizes = np.diff(at) + 1
            until = np.cumsum(sizes)
            whole = np.full(int(until[-1]), end_id, dtype="<u4")
            keep = np.ones(len(whole), dtype=bool)
            keep[until - 1] = False
            whole[keep] = ids
            pieces = -(-sizes // capacity)
            row = np.repeat(np.arange(n), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(capacity, sizes[row] - start)
            a = until[row] - sizes[row] + start
            view = memoryview(whole).cast("B")
            crc = np.fromiter((zlib.crc32(view[4 * x : 4 * (x + k)]) for x, k in zip(a.tolist(), length.tolist(), strict=True)), np.int64, len(row))
            yield pa.RecordBatch.from_arrays(
                [step.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


def pack(pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, stream: int = STREAM) -> DataFrame:
    """Adds sequence_id and offset to a table of pieces.  Repeated rows are separate pieces."""
    part = pieces.filter(F.col("length") < capacity)
    streams = max(1, -(-part.count() // stream))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        base = (TaskContext.get().partitionId() + 1) << 34
        bins = BestFit(capacity, open_bins)
        for frame in frames:
            put = [bins.put(n) for n in frame["length"].tolist()]
            at = np.array(put, dtype=np.int64).reshape(-1, 2)
            yield frame.assign(sequence_id=base + at[:, 0], offset=at[:, 1])

    # Sorted within a stream by a hash, so that a task run again packs the same way.
    dealt = part.repartition(streams).sortWithinPartitions(F.xxhash64("doc_id", "piece"), "doc_id", "piece", "ids_crc32")
    packed = dealt.mapInPandas(run, f"{PIECES}, sequence_id bigint, offset bigint")
    full = pieces.filter(F.col("length") == capacity).withColumns(
        {"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("bigint")}
    )
    return packed.unionByName(full)


def best_fit(docs: DataFrame, vocab_path: str | None = None) -> DataFrame:
    return pack(save(cut(docs, vocab_path), "pieces"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit(table(spark, sf_dir, "documents"))
