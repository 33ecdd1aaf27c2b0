"""Small helpers that the operators of this package share."""

from __future__ import annotations

import io
import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercadal.session import scratch_path

SLICE_BYTES = 4 << 20


def show_package(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it, for
    sessions that were not started in its folder."""
    home = str(Path(__file__).resolve().parents[2])
    given = spark.sparkContext.environment.get("PYTHONPATH", "")
    if home not in given.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [given, home]))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    show_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` to the shared folder, compressed, and reads it back.

    What follows starts from the files, so a lost executor costs at most the
    tasks that were running, and ids given in the writing step stay as they are.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def utf8_values(column: pa.Array) -> list[bytes]:
    """The strings of an Arrow column as UTF-8; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [v or b"" for v in column.cast(kind).to_pylist()]


def slices(values: list[bytes], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``limit`` bytes each (a longer row stands alone)."""
    start, size = 0, 0
    for i, v in enumerate(values):
        if i > start and size + len(v) > limit:
            yield start, i
            start, size = i, 0
        size += len(v)
    if start < len(values):
        yield start, len(values)


def packed(*arrays: np.ndarray) -> bytes:
    """Some arrays as one compressed value of a row."""
    to = io.BytesIO()
    for a in arrays:
        np.save(to, a, allow_pickle=False)
    return zstandard.ZstdCompressor(level=1).compress(to.getvalue())


def unpacked(raw: bytes) -> list[np.ndarray]:
    source = io.BytesIO(zstandard.ZstdDecompressor().decompress(raw))
    size, out = len(source.getbuffer()), []
    while source.tell() < size:
        out.append(np.load(source, allow_pickle=False))
    return out


def runs_of(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of the runs of equal neighbours."""
    if len(values):
        cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
        yield from zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)], strict=True)
