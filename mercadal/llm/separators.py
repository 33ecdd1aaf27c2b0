"""Token counts from flat token files by a scan for the end-of-document id.

A token file is a plain row of 16-bit ids, each document ended by ``END_ID``,
with no index of where documents begin. It is read in blocks of fixed size that
know nothing of documents. Each block is searched at once as an array; it
reports the ids before its first separator, the lengths between separators and
the ids after the last one. A prefix scan over the blocks of a file then hands
each block the ids left open before it and the number of separators passed, so
that a document cut by any number of block borders is counted as a whole.

A document without ids has length zero; ids after the last separator of a file
make a last row with ``terminated`` false. Null texts count as empty, repeated
rows and null ids are fine, extra columns are not read, empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercadal.llm.tables import slices, stored, text_or_empty, utf8_values
from mercadal.llm.tokens import encoder, vocabulary_path

END_ID = 49407
BLOCK_IDS = 1 << 18


def token_files(docs: DataFrame, block_ids: int = BLOCK_IDS, vocabulary: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Writes the documents as flat token files, one per partition of ``docs``.

    Returns the blocks (file, block, ids) and, apart from them, which document
    each file holds at which place (file, place, doc_id). Control strings in a
    text are ordinary text, so no text holds the end id.
    """
    path, end = vocabulary or vocabulary_path(), END_ID.to_bytes(2, "little")

    def run(batches):
        coder, file = encoder(path, plain_specials=True), TaskContext.get().partitionId()
        block, place, open_bytes = 0, 0, bytearray()

        def row(ids, doc_ids):
            columns = [[file], [block if ids is not None else None], [ids], [place], [doc_ids]]
            kinds = (pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(columns, kinds, strict=True)],
                names=["file", "block", "ids", "place", "doc_ids"],
            )

        for batch in batches:
            texts, doc_ids = utf8_values(batch.column(1)), batch.column(0).to_pylist()
            for a, b in slices(texts):
                open_bytes += end.join([*coder.encode([t.decode("utf-8") for t in texts[a:b]]), b""])
                yield row(None, doc_ids[a:b])
                place += b - a
                while len(open_bytes) >= 2 * block_ids:
                    yield row(bytes(open_bytes[: 2 * block_ids]), None)
                    del open_bytes[: 2 * block_ids]
                    block += 1
        if open_bytes:
            yield row(bytes(open_bytes), None)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    both = stored(texts.mapInArrow(run, "file int, block long, ids binary, place long, doc_ids array<long>"), "token_files")
    blocks = both.where("block is not null").select("file", "block", "ids")
    held = both.where("block is null").select("file", "place", F.posexplode("doc_ids").alias("i", "doc_id"))
    return blocks, held.select("file", (F.col("place") + F.col("i")).alias("place"), "doc_id")


def scan_blocks(blocks: DataFrame, end_id: int = END_ID) -> DataFrame:
    """(file, block, n, seps, head, tail, inner) of each block: its ids, its
    separators, the ids before the first and after the last of them (both all
    ids if there is none) and the ids between them."""

    def run(batches):
        for batch in batches:
            rows = []
            for ids in batch.column(2):
                values = np.frombuffer(ids.as_buffer(), dtype="<u2") if ids.as_py() else np.empty(0, dtype="<u2")
                at = np.flatnonzero(values == end_id)
                n = len(values)
                ends = (int(at[0]), n - int(at[-1]) - 1) if len(at) else (n, n)
                rows.append((n, len(at), *ends, np.diff(at) - 1))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
            columns = [pa.array(list(c), type=t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *columns],
                names=["file", "block", "n", "seps", "head", "tail", "inner"],
            )

    schema = "file int, block long, n long, seps long, head long, tail long, inner array<long>"
    return blocks.select(F.col("file").cast("int"), F.col("block").cast("long"), "ids").mapInArrow(run, schema)


def document_lengths(blocks: DataFrame, end_id: int = END_ID) -> DataFrame:
    """(file, place, n_tokens, terminated) of the documents of flat token files;
    the end id itself is not counted."""
    found = stored(scan_blocks(blocks, end_id), "scanned")
    order = Window.partitionBy("file").orderBy("block")
    past = order.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    placed = found.select(
        "*",
        F.coalesce(F.sum("n").over(past), zero).alias("first"),
        F.coalesce(F.sum("seps").over(past), zero).alias("passed"),
        F.lead("block").over(order).isNull().alias("last"),
    )
    # where the last document that ended before this block ended
    ended = F.when(F.col("seps") > 0, F.col("first") + F.col("n") - F.col("tail"))
    placed = placed.withColumn("open", F.col("first") - F.coalesce(F.max(ended).over(past), zero))
    lengths = F.concat(F.array(F.col("open") + F.col("head")), "inner")
    closed = placed.where("seps > 0").select("file", "passed", F.posexplode(lengths).alias("i", "n_tokens"))
    closed = closed.select("file", (F.col("passed") + F.col("i")).alias("place"), "n_tokens", F.lit(True).alias("terminated"))
    left = F.when(F.col("seps") > 0, F.col("tail")).otherwise(F.col("open") + F.col("n"))
    rest = placed.where(F.col("last") & (left > 0)).select(
        "file", (F.col("passed") + F.col("seps")).alias("place"), left.alias("n_tokens"), F.lit(False).alias("terminated")
    )
    return closed.unionByName(rest)


def token_counts(docs: DataFrame, block_ids: int = BLOCK_IDS) -> DataFrame:
    """doc_id and n_tokens of every document, counted in its token file."""
    blocks, held = token_files(docs, block_ids)
    counted = document_lengths(blocks)
    return held.join(counted, ["file", "place"]).select("doc_id", "n_tokens")
