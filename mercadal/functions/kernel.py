"""CPU-bound trigonometric kernel evaluated per row."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType


def trig_kernel(x: Column, terms: int = 50) -> Column:
    """Left-to-right sum of ``sin(x) * cos(x + i)`` for i = 0 .. terms-1.

    The sum is spelt out as one expression rather than folded over an array:
    higher-order functions are interpreted, plain arithmetic is compiled.
    ``sin(x)`` is a common subexpression and is evaluated once per row.
    """
    x = x.cast("double")
    total = F.lit(0.0)
    for i in range(terms):
        total = total + F.sin(x) * F.cos(x + F.lit(float(i)))
    return total


def trig_kernel_arrow(df: DataFrame, column: str, out: str, terms: int = 50) -> DataFrame:
    """The same kernel over Arrow batches; kept as an independent check."""

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            x = frame[column].to_numpy(dtype="float64")
            total = np.zeros_like(x)
            for i in range(terms):
                total += np.sin(x) * np.cos(x + i)
            yield frame.assign(**{out: total})

    schema = StructType([*df.schema.fields, StructField(out, DoubleType())])
    return df.mapInPandas(batches, schema=schema)
