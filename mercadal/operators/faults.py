"""Plants faults in the rows of a frame, so that rules meet what they look for.

Which rows are hit depends on their keys alone: a row is dealt a number from its
key by a multiplicative step, and each fault takes the rows whose number leaves
its remainder. So the same rows are hit under any partitioning, and plain SQL
can name them too.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEP, MODULUS = 48_271, 2_147_483_647


@dataclass(frozen=True)
class Fault:
    """Sets ``column`` to ``value`` (null if not given) in one row of ``every``:
    those whose number leaves ``at``."""

    column: str
    every: int
    at: int
    value: object = None


@dataclass(frozen=True)
class Copies:
    """Repeats one row of ``every``, ``times`` more."""

    every: int
    at: int
    times: int = 1


def dealt(key: Column) -> Column:
    """The number a whole-number key is dealt, from 0 up to ``MODULUS``; null is
    dealt as zero."""
    number = F.pmod(F.coalesce(key.cast("bigint"), F.lit(0)), F.lit(MODULUS))
    return F.pmod(number * F.lit(STEP), F.lit(MODULUS))


def with_faults(df: DataFrame, key: Column, faults: Sequence[Fault | Copies], copy: str = "_copy") -> DataFrame:
    """``df`` with all ``faults`` and a column ``copy``: 0 for a row itself, 1
    and up for its repetitions. Columns keep their types; a row may be hit by
    more than one fault, and its copies carry the same ones."""
    number = dealt(key)
    columns = {c: F.col(c) for c in df.columns}
    times = F.lit(0)
    for fault in faults:
        hit = number % F.lit(fault.every) == F.lit(fault.at)
        if isinstance(fault, Copies):
            times = times + F.when(hit, F.lit(fault.times)).otherwise(F.lit(0))
            continue
        kind = df.schema[fault.column].dataType
        columns[fault.column] = F.when(hit, F.lit(fault.value).cast(kind)).otherwise(columns[fault.column])
    repeated = F.explode(F.sequence(F.lit(0), times)).alias(copy)
    return df.select(*[made.alias(name) for name, made in columns.items()], repeated)
