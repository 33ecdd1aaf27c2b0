"""Packing by concatenation and cutting.

Pass one encodes every document once and stores, beside its ids, the number of
ids before it in its own partition. The partition totals, summed up in order,
give each partition its place in one endless row of ids. Pass two cuts that row
in windows of fixed length; a document that a window border crosses leaves one
boundary record (piece) per window.

No window but the last is padded, and no id is dropped or stored twice.
Null and empty texts consist of the end id alone. Repeated rows, rows without
``doc_id`` and very long texts are packed like any other; extra columns are not
read. An empty table gives no pieces.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercadal.llm.tables import slices, stored, text_or_empty, utf8_values
from mercadal.llm.tokens import encoder, vocabulary_path

WINDOW = 2048
END_ID = 1

ENCODED = "doc_id long, part int, before long, n_ids long, ids binary"
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


def encode_documents(docs: DataFrame, vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Pass one, stored: ids of each document, ended by ``end_id``, and the
    number of ids before it in its partition."""
    path = vocabulary or vocabulary_path()
    end = end_id.to_bytes(2, "little")

    def run(batches):
        coder, part, before = encoder(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = utf8_values(batch.column(1))
            for a, b in slices(texts):
                ids = [x + end for x in coder.encode([t.decode("utf-8") for t in texts[a:b]])]
                counts = np.array([len(x) // 2 for x in ids], dtype=np.int64)
                starts = before + np.cumsum(counts) - counts
                before += int(counts.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array(np.full(b - a, part, dtype=np.int32)),
                        pa.array(starts),
                        pa.array(counts),
                        pa.array(ids, type=pa.binary()),
                    ],
                    names=["doc_id", "part", "before", "n_ids", "ids"],
                )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return stored(texts.mapInArrow(run, ENCODED), "packing")


def partition_offsets(encoded: DataFrame) -> DataFrame:
    """Exclusive prefix sums of the partition totals: one row per partition of
    pass one, so the window below sees as many rows as there were tasks."""
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = encoded.groupBy("part").agg(F.sum("n_ids").alias("total"))
    return totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))


def cut_windows(encoded: DataFrame, window: int = WINDOW) -> DataFrame:
    """Pass two: the pieces of all documents, in windows of ``window`` ids."""

    def run(batches):
        for batch in batches:
            doc_ids, firsts, counts = batch.column(0), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            rows: list[list[int]] = [[] for _ in range(7)]
            for i, packed in enumerate(batch.column(3)):
                ids = np.frombuffer(packed.as_buffer(), dtype="<u2").astype("<u4")
                first, n = int(firsts[i]), int(counts[i])
                start = 0
                while start < n:
                    sequence, offset = divmod(first + start, window)
                    length = min(window - offset, n - start)
                    crc = zlib.crc32(ids[start : start + length].tobytes())
                    for column, value in zip(rows, (i, start, length, crc, n, sequence, offset), strict=True):
                        column.append(value)
                    start += length
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            values = [doc_ids.take(pa.array(rows[0], type=pa.int64()))]
            values += [pa.array(r, type=pa.int64()) for r in rows[1:]]
            yield pa.RecordBatch.from_arrays(values, names=names)

    # one row per partition of pass one: a few bytes for each of the scan's tasks
    placed = encoded.join(F.broadcast(partition_offsets(encoded)), "part")
    placed = placed.select("doc_id", (F.col("base") + F.col("before")).alias("first"), "n_ids", "ids")
    return placed.mapInArrow(run, PIECES)


def concat_and_cut(docs: DataFrame, window: int = WINDOW, vocabulary: str | None = None) -> DataFrame:
    return cut_windows(encode_documents(docs, vocabulary), window)
