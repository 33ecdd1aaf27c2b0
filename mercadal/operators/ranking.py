"""Exact global ranks, quintiles and quantiles without a single-task window.

The rows are range-partitioned on the whole sort key, sorted inside each
partition and written once. The written position is data from then on, so the
prefix sums over the partitions and the rows always agree, whatever is re-run.
Sort keys must end in a unique column: heavy ties are then split like any
other range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercadal.functions.exact import of_order_key, with_order_key
from mercadal.operators.joins import cross_one_row
from mercadal.session import materialize

NARROW_BITS = 21  # of an ordered key found by one scan, and one more by the first
PARTITION_BITS = 33  # monotonically_increasing_id keeps the row index below this bit


def _laid_out(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Written copy of ``df`` with ``_part`` (range) and ``_pos`` (row in it)."""
    laid = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_seq", F.monotonically_increasing_id())
    )
    stored = materialize(laid, "ordered")
    return (
        stored.withColumn("_part", F.shiftright("_seq", PARTITION_BITS))
        .withColumn("_pos", F.col("_seq").bitwiseAND(F.lit((1 << PARTITION_BITS) - 1)))
    )


def _with_offset(laid: DataFrame, weight: Column) -> DataFrame:
    """Adds ``_before``: the total weight of all earlier range partitions.

    The offset table has one row per range partition, never more than the
    shuffle partition count, so it is safe to broadcast and to window over.
    """
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        laid.groupBy("_part")
        .agg(F.sum(weight).alias("_w"))
        .select("_part", F.coalesce(F.sum("_w").over(earlier), F.lit(0)).alias("_before"))
    )
    return laid.join(F.broadcast(offsets), "_part")


def distributed_row_number(
    df: DataFrame, order: Sequence[Column | str], out: str = "rn"
) -> DataFrame:
    """Adds the 1-based global position under ``order`` (unique sort key)."""
    laid = _with_offset(_laid_out(df, order), F.lit(1))
    ranked = laid.withColumn(out, F.col("_before") + F.col("_pos") + F.lit(1))
    return ranked.select(*df.columns, out)


def quintile(rank: Column, n: Column) -> Column:
    """Score 1-5 of a 1-based rank among ``n``: equal-frequency cut points
    interpolated on the ranks. One row scores 1. Differs from ``ntile``."""
    r, n = rank.cast("bigint"), n.cast("bigint")
    scaled = F.lit(5) * (r - F.lit(1)) + n - F.lit(2)
    cut = F.floor(scaled / F.nullif(n - F.lit(1), F.lit(0)))
    return F.greatest(F.lit(1), F.coalesce(cut, F.lit(1))).cast("int")


def quintile_score(df: DataFrame, order: Sequence[Column | str], out: str) -> DataFrame:
    """Adds the exact quintile of each row under ``order``."""
    ranked = distributed_row_number(df, order, "_rn")
    size = ranked.agg(F.max("_rn").alias("_n"))
    scored = cross_one_row(ranked, size).withColumn(out, quintile(F.col("_rn"), F.col("_n")))
    return scored.select(*df.columns, out)


def quintiles_by_measure(
    long: DataFrame, measure: str, order: Sequence[Column | str], out: str
) -> DataFrame:
    """Quintile of every row inside its measure, all measures in one sort.

    ``long`` stacks a fixed handful of measures (R, F and M; the criteria of a
    score matrix), so the table of their first ranks has that many rows.
    """
    ranked = distributed_row_number(long, [F.col(measure), *order], "_rn")
    bounds = ranked.groupBy(F.col(measure).alias("_measure")).agg(
        F.min("_rn").alias("_first"), F.max("_rn").alias("_last")
    )
    rank = F.col("_rn") - F.col("_first") + F.lit(1)
    size = F.col("_last") - F.col("_first") + F.lit(1)
    # one row per measure, a handful by contract
    joined = ranked.join(F.broadcast(bounds), ranked[measure] == bounds["_measure"])
    return joined.withColumn(out, quintile(rank, size)).select(*long.columns, out)


def exact_quantiles(
    df: DataFrame, value: str, probs: dict[str, float], by: Sequence[str] = (), store: bool = False
) -> DataFrame:
    """Exact, linearly interpolated quantiles of the non-null values (NaN is the
    largest of them).

    One output column per entry of ``probs``; one row per group of ``by``, or
    one row in all. ``by`` names the members of a closed domain (statuses,
    categories): a few rows per member are broadcast.

    The values themselves are never shuffled, nor written but with ``store``,
    which works their keys out once instead of in every scan. They are read as 64-bit
    keys that sort alike, and ``NARROW_BITS`` at a time the key of every wanted
    position is found: a histogram over the next bits of the values that share
    the bits found so far (counted map-side, at most 2^22 rows per
    position) tells in which bucket the position lies and what is left of it.
    """
    by = list(by)
    values = df.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("_value"))
    keyed = with_order_key(values, F.col("_value"), "_key").select(*by, "_key")
    if store:
        keyed = materialize(keyed, "keys")

    lead = F.shiftright("_key", 2 * NARROW_BITS)
    counts = keyed.groupBy(*by, lead.alias("_b")).agg(F.count(F.lit(1)).alias("_c"))
    counts = counts.withColumn("_n", F.sum("_c").over(Window.partitionBy(*by)))
    spots = [F.lit(float(p)) * (F.col("_n") - F.lit(1)) for p in probs.values()]
    # a column for the position below and the one above each quantile
    targets = [f"_t{i}" for i in range(2 * len(spots))]
    ends = [end(spot) for spot in spots for end in (F.floor, F.ceil)]
    first = counts.withColumns(dict(zip(targets, ends, strict=True)))
    wanted = _inside(first, by, targets).withColumnRenamed("_b", "_prefix")
    for shift in (NARROW_BITS, 0):
        wanted = _narrowed(keyed, by, wanted, targets, shift)

    found = wanted.select(*by, "_n", of_order_key(F.col("_prefix")).alias("_v"), *targets)
    at = [F.max(F.when(F.col(t).isNotNull(), F.col("_v"))) for t in targets]
    shares = [F.max(spot - F.floor(spot)) for spot in spots]
    results = [
        F.when(low == high, low).otherwise(low + (high - low) * share).alias(name)
        for name, low, high, share in zip(probs, at[::2], at[1::2], shares, strict=True)
    ]
    return found.groupBy(*by).agg(*results)


def _inside(counts: DataFrame, within: list[str], targets: list[str]) -> DataFrame:
    """Keeps of a histogram (_b, _c) the buckets that hold a target, with the
    targets' positions inside the bucket; null for those that it does not hold."""
    upto = Window.partitionBy(*within).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    placed = counts.withColumn("_before", F.sum("_c").over(upto) - F.col("_c"))
    before, after = F.col("_before"), F.col("_before") + F.col("_c")
    here = {t: F.when((F.col(t) >= before) & (F.col(t) < after), F.col(t) - before) for t in targets}
    return placed.withColumns(here).where(F.coalesce(*targets).isNotNull()).drop("_before", "_c")


def _narrowed(
    keyed: DataFrame, by: list[str], wanted: DataFrame, targets: list[str], shift: int
) -> DataFrame:
    """The same with ``NARROW_BITS`` more bits of the key found, by one more scan."""
    sought = wanted.select(*[F.col(k).alias(f"_of_{k}") for k in by], "_prefix", "_n", *targets)
    # null-safe, though keys are never null: else the key is worked out again in a filter
    same = F.shiftright("_key", shift + NARROW_BITS).eqNullSafe(F.col("_prefix"))
    for k in by:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    bucket = F.shiftright("_key", shift).bitwiseAND(F.lit((1 << NARROW_BITS) - 1))
    # at most two rows for each quantile of each member of the domain
    rows = keyed.join(F.broadcast(sought), same)
    counts = rows.groupBy(*by, "_prefix", bucket.alias("_b")).agg(
        F.count(F.lit(1)).alias("_c"), *[F.max(c).alias(c) for c in ("_n", *targets)]
    )
    longer = F.shiftleft("_prefix", NARROW_BITS).bitwiseOR(F.col("_b"))
    return _inside(counts, [*by, "_prefix"], targets).withColumn("_prefix", longer).drop("_b")
