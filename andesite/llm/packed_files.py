"""Packed id matrices: best-fit-decreasing packing, written as binary columns.

Every document becomes its ids and one id 0.  Documents longer than a row are split losslessly into
full rows and a rest.  Each task packs its own documents in pools of ``POOL_TOKENS``: pieces by
decreasing length go into the open row with the least room that is enough, which a segment tree
over room sizes finds.  Nothing is shuffled; a pool leaves at most its last rows partly filled.

A row holds ``input_ids`` (``width`` ids, 0 at the end, little-endian, 16 bits each if the
vocabulary allows, else 32), ``cu_seqlens`` (segment bounds from 0 on, the last being the filled
length), ``position_ids`` (32 bits each, starting at 0 in every segment and in the padding), and
``doc_ids``, ``starts`` and ``doc_tokens`` of the segments.

Null and empty texts are the id 0 alone.  Repeated rows are packed each; a null doc_id stays null.
Further columns are ignored, an empty table gives no rows, and a very long text is split.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, types as T

from andesite.llm.tokens import END_OF_DOCUMENT, TokenIds

WIDTH = 2048
POOL_TOKENS = 1_500_000
# Rows of one task are numbered from its partition number times this.
ROWS_PER_TASK = 1 << 40

PACKED = T.StructType([
    T.StructField("sequence_id", T.LongType()), T.StructField("input_ids", T.BinaryType()),
    T.StructField("cu_seqlens", T.ArrayType(T.IntegerType())),
    T.StructField("position_ids", T.BinaryType()),
    T.StructField("doc_ids", T.ArrayType(T.LongType())),
    T.StructField("starts", T.ArrayType(T.LongType())),
    T.StructField("doc_tokens", T.ArrayType(T.LongType())),
])
ARROW_PACKED = pa.schema([
    ("sequence_id", pa.int64()), ("input_ids", pa.binary()), ("cu_seqlens", pa.list_(pa.int32())),
    ("position_ids", pa.binary()), ("doc_ids", pa.list_(pa.int64())),
    ("starts", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())),
])
DIGEST = T.StructType([
    T.StructField(c, T.LongType())
    for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
])


class RoomTree:
    """Open rows by the room they have left; finds the least room that is enough.

    A segment tree over room sizes holds the number of open rows below each node.
    """

    def __init__(self, width: int):
        self.size = 1 << width.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(width + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._change(room, 1)

    def _change(self, room: int, by: int) -> None:
        node = room + self.size
        while node:
            self.count[node] += by
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """A row with the least room of at least ``need``, and that room."""
        count, node = self.count, need + self.size
        if not count[node]:
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node *= 2
                if not count[node]:
                    node += 1
        room = node - self.size
        self._change(room, -1)
        return self.rows[room].pop(), room


def best_fit_decreasing(lengths: list[int], width: int) -> list[list[int]]:
    """Indices of the items of each row; no row holds more than ``width``."""
    rows: list[list[int]] = []
    tree = RoomTree(width)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = tree.take(lengths[i])
        row, room = found if found else (len(rows), width)
        if not found:
            rows.append([])
        rows[row].append(i)
        if room > lengths[i]:
            tree.add(room - lengths[i], row)
    return rows


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, width: int = WIDTH) -> DataFrame:
    """The packed rows of the documents."""
    path = tokenizer_path or public_tokenizers.path("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TokenIds.at(path)
        kind = "<u2" if encoder.encoding.max_token_value < 1 << 16 else "<u4"
        sequence = TaskContext.get().partitionId() * ROWS_PER_TASK
        ramp = np.arange(width, dtype="<i4")

        def packed(pool: list[tuple]) -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            rows = best_fit_decreasing([len(ids) // 4 for *_, ids in pool], width)
            for at in range(0, len(rows), 512):
                out: list[list] = [[] for _ in ARROW_PACKED]
                for row in rows[at : at + 512]:
                    ids = np.zeros(width, kind)
                    bounds = [0]
                    position = np.empty(width, "<i4")
                    for i in row:
                        piece = np.frombuffer(pool[i][3], "<u4")
                        end = bounds[-1] + len(piece)
                        ids[bounds[-1] : end] = piece
                        position[bounds[-1] : end] = ramp[: len(piece)]
                        bounds.append(end)
                    position[bounds[-1] :] = ramp[: width - bounds[-1]]
                    values = (sequence, ids.tobytes(), bounds, position.tobytes(),
                              *([pool[i][c] for i in row] for c in range(3)))
                    for column, value in zip(out, values):
                        column.append(value)
                    sequence += 1
                arrays = [pa.array(v, f.type) for v, f in zip(out, ARROW_PACKED)]
                yield pa.RecordBatch.from_arrays(arrays, schema=ARROW_PACKED)

        pool: list[tuple] = []
        size = 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                ids = encoder.encode(text.as_py()) + END_OF_DOCUMENT
                total = len(ids) // 4
                for start in range(0, total, width):
                    pool.append((doc_id.as_py(), start, total, ids[4 * start : 4 * (start + width)]))
                size += total
                if size >= POOL_TOKENS:
                    yield from packed(pool)
                    pool, size = [], 0
        if pool:
            yield from packed(pool)

    return docs.select("doc_id", "text").mapInArrow(run, PACKED)


def write_packed(docs: DataFrame, folder: str, **options) -> DataFrame:
    """Write the packed rows as Parquet files into ``folder`` and return what was written."""
    pack_documents(docs, **options).write.option("compression", "zstd").parquet(folder)
    return docs.sparkSession.read.schema(PACKED).parquet(folder)


def packed_pieces(packed: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per segment of the packed rows, with the checksum of its 32-bit ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("sequence_id", "input_ids", "cu_seqlens", "doc_ids", "starts", "doc_tokens")
        for batch in batches:
            out: list[list[int]] = [[] for _ in DIGEST]
            for sequence, ids, bounds, doc_ids, starts, totals in zip(
                *(batch.column(c).to_pylist() for c in names)
            ):
                kind = "<u2" if len(ids) == 2 * width else "<u4"
                wide = np.frombuffer(ids, kind).astype("<u4")
                for i, (begin, end) in enumerate(zip(bounds, bounds[1:])):
                    row = (doc_ids[i], starts[i], end - begin, zlib.crc32(wide[begin:end]),
                           totals[i], sequence, begin)
                    for column, value in zip(out, row):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], DIGEST.names)

    return packed.mapInArrow(run, DIGEST)
