"""Session set-up and the shared scratch area for intermediate tables."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

# Settings the library relies on. AQE supplies partition coalescing, skew
# splitting and size-checked broadcasts; UTC keeps text stamps comparable.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


# bytes of input that one shuffle task should have to deal with
TASK_BYTES = 128 << 20
# intermediate tables that this process has asked paths for
_written: list[str] = []


def build_session(
    app: str = "mercadal", master: str | None = None, **conf: str
) -> SparkSession:
    """Session with the defaults above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_table(spark: SparkSession, rows: list[tuple], schema: str | StructType) -> DataFrame:
    """Hand-written rows (weights, catalogs) as a relation of known size."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    arrow = pa.Table.from_arrays(
        [
            pa.array(list(values), type=to_arrow_type(field.dataType))
            for values, field in zip(columns, schema.fields, strict=True)
        ],
        names=schema.fieldNames(),
    )
    return spark.createDataFrame(arrow, schema=schema)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own: on a
    cluster a machine-local path would be invisible to the other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    root = context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="mercadal-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def _file_system(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, the intermediate tables that were begun inside it;
    frames that were built on them cannot be read any more."""
    before = len(_written)
    try:
        yield
    finally:
        while len(_written) > before:
            files, place = _file_system(spark, _written.pop())
            files.delete(place, True)


def shuffle_partitions(input_bytes: int, least: int = 1) -> int:
    return max(least, math.ceil(input_bytes / TASK_BYTES))


def size_shuffles(spark: SparkSession, *paths: str) -> int:
    """Makes shuffles and range partitionings start with one task per
    ``TASK_BYTES`` of the inputs, or as many as are set if that is more;
    adaptive execution merges those that prove small."""
    total = 0
    for path in paths:
        files, place = _file_system(spark, path)
        for found in files.globStatus(place) or []:
            total += files.getContentSummary(found.getPath()).getLength()
    number = shuffle_partitions(total, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set("spark.sql.shuffle.partitions", str(number))
    return number


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the files.

    Cuts lineage in a way that survives executor loss: later stages re-read
    files instead of re-running shuffles whose outcome they must agree on.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
