"""Group-level operators: shares, running totals, pivots, top-k, funnels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercadal.functions.exact import exact_means
from mercadal.functions.scalars import half_up, percent
from mercadal.session import materialize


def without_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drops rows with a null group key (dataframe-library grouping)."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).isNotNull()
    return df.where(condition)


def share_of_total(groups: DataFrame, col: str, out: str, digits: int = 2) -> DataFrame:
    """Percentage of ``col`` in the sum over all rows of an aggregated frame.

    ``groups`` holds one row per member of a closed domain (category, country,
    channel), so the unpartitioned window sees that many rows.
    """
    whole = F.sum(col).over(Window.partitionBy())
    return groups.withColumn(out, percent(F.col(col), whole, digits))


def running_total(groups: DataFrame, order: Sequence[str], col: str, out: str) -> DataFrame:
    """Cumulative sum over an aggregated calendar frame (a row per period)."""
    upto = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return groups.withColumn(out, F.sum(F.col(col).cast("decimal(38,6)")).over(upto).cast("double"))


def pivot_sum(
    df: DataFrame,
    row: str,
    col: str,
    values: Sequence[str],
    value: str,
    total: str | None = None,
) -> DataFrame:
    """``row`` x ``col`` table of sums; absent cells are 0.

    ``values`` come first, in that order, present or not; other values of ``col``
    follow, sorted. The total adds every cell that has a column. The cells are
    summed up and stored before the columns are looked for: they are few.
    """
    cells = materialize(
        df.where(F.col(col).isNotNull()).groupBy(row, col).agg(F.sum(value).alias("_cell")), "cells"
    )
    found = {r[0] for r in cells.select(F.col(col).cast("string")).distinct().collect()}
    names = [*values, *sorted(found - set(values))]
    table = cells.groupBy(row).pivot(col, names).agg(F.first("_cell")).na.fill(0)
    if total:
        sums = cells.groupBy(F.col(row).alias("_of")).agg(F.sum("_cell").alias(total))
        table = table.join(sums, F.col(row).eqNullSafe(F.col("_of"))).drop("_of")
    return table


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows; planned as per-partition heaps and one merge."""
    return df.orderBy(*order).limit(k)


def preview(df: DataFrame, rows: int = 5, columns: int = 8) -> DataFrame:
    return df.select(df.columns[:columns]).limit(rows)


def conversion_funnel(
    events: DataFrame, steps: Sequence[str], session: str, kind: str
) -> DataFrame:
    """Distinct sessions per step, share of all sessions, rate to the step before.

    The funnel is open: a step counts the sessions that have it, whatever came
    before. One scan: each session is first reduced to one flag per step, so a
    session with very many events collapses before the shuffle.
    """
    flags = [F.max(F.col(kind).eqNullSafe(step)).alias(f"_s{i}") for i, step in enumerate(steps)]
    sessions = events.where(F.col(session).isNotNull()).groupBy(session).agg(*flags)
    totals = sessions.agg(
        F.count(F.lit(1)).alias("_all"),
        *[F.count_if(f"_s{i}").alias(f"_s{i}") for i in range(len(steps))],
    )
    entries = F.array(
        *[
            F.struct(F.lit(step).alias("step"), F.col(f"_s{i}").alias("sessions"))
            for i, step in enumerate(steps)
        ]
    )
    rows = totals.select("_all", F.posexplode(entries).alias("_at", "_e")).select(
        "_all", "_at", "_e.step", "_e.sessions"
    )
    in_order = Window.orderBy("_at")  # as many rows as there are steps
    previous = F.lag("sessions").over(in_order)
    return (
        rows.withColumn("previous_sessions", previous)
        .withColumn("pct_of_total", percent(F.col("sessions"), F.greatest("_all", F.lit(1))))
        .withColumn("step_rate", percent(F.col("sessions"), F.col("previous_sessions")))
        .orderBy("_at")
        .select("step", "sessions", "pct_of_total", "previous_sessions", "step_rate")
    )


def behaviour_by(
    events: DataFrame, keys: Sequence[str], session: str, duration: str, kind: str, bought: str
) -> DataFrame:
    """Sessions, duration and purchases per key group; null keys form a group.

    Null counts as one value among the distinct sessions.
    """
    distinct = F.count_distinct(session) + F.coalesce(
        F.max(F.col(session).isNull()), F.lit(False)
    ).cast("bigint")
    named = [F.col(k).alias(f"_of_{k}") for k in keys]
    sessions = events.groupBy(*named).agg(distinct.alias("unique_sessions"))
    counts = {
        "num_sessions": ("sum", F.count(session)),
        "max_duration": ("max", F.max(duration)),
        "num_purchases": ("sum", F.count_if(F.col(kind) == bought)),
    }
    lasting = exact_means(events, keys, F.col(duration), "_mean", counts)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return (
        lasting.join(sessions, same)
        .withColumn("mean_duration", half_up(F.col("_mean"), 2))
        .select(*keys, "num_sessions", "unique_sessions", "mean_duration", "max_duration", "num_purchases")
        .orderBy(F.desc("num_sessions"), *keys)
    )
