"""Sums that do not depend on order, and the order-preserving form of doubles.

A double is split by its exponent: ``bin_of`` names a bin of ``STEP`` binary
orders, and inside a bin the number is three whole numbers of 21 bits. Whole
numbers add up exactly in 64 bits, whatever comes first, and are combined before
they are shuffled, so partitioning and re-run tasks do not change a bit of the
result. A group has one partial row per bin that occurs, never more than 525.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEP = 4
FIRST, NEXT = 16, 21  # bits after the point of the first part, of the other two
MERGES = {"sum": F.sum, "min": F.min, "max": F.max}


def finite(col: Column) -> Column:
    """The number as a double; NaN counts as null."""
    x = col.cast("double")
    return F.when(~F.isnan(x), x)


def power_of_two(exponent: Column) -> Column:
    return F.pow(F.lit(2.0), exponent.cast("double"))


def bin_of(x: Column) -> Column:
    """Which ``STEP`` binary orders the number belongs to; 0 for zero. A logarithm
    that is rounded across a border names the next bin, which serves as well."""
    return F.coalesce(F.floor(F.log2(F.abs(x)) / STEP), F.lit(0)).cast("int")


def with_parts(df: DataFrame) -> DataFrame:
    """Adds ``_p0``, ``_p1`` and ``_p2``, whole numbers that make up ``_x`` exactly in
    units of its ``_bin``. A column for each step, so that none is worked out twice."""
    half = power_of_two(-F.col("_bin") * (STEP // 2))  # twice, as one factor might not be finite
    steps = df.withColumn("_half", half).withColumn("_scaled", F.col("_x") * F.col("_half") * F.col("_half") * 2.0**FIRST)
    steps = steps.withColumn("_p0", F.floor("_scaled"))
    steps = steps.withColumn("_rest", (F.col("_scaled") - F.col("_p0").cast("double")) * 2.0**NEXT)
    steps = steps.withColumn("_p1", F.floor("_rest"))
    return steps.withColumn("_p2", ((F.col("_rest") - F.col("_p1").cast("double")) * 2.0**NEXT).cast("bigint"))


def _two_sum(a: Column, b: Column) -> tuple[Column, Column]:
    s = a + b
    part = s - a
    return s, (a - (s - part)) + (b - part)


def _combined(bins: Column) -> Column:
    """Value of the whole-number sums of all bins, the largest bin first, carried
    as the sum of two doubles (106 bits)."""

    def pieces(entry: Column) -> Column:
        half = power_of_two(entry["bin"] * (STEP // 2))
        out, shift = [], 0
        for name, bits in (("p0", FIRST), ("p1", NEXT), ("p2", NEXT)):
            shift += bits
            # both halves of a sum are doubles without rounding
            high, low = F.shiftright(entry[name], 32), entry[name].bitwiseAND(F.lit((1 << 32) - 1))
            out += [high.cast("double") * 2.0 ** (32 - shift) * half * half, low.cast("double") * 2.0**-shift * half * half]
        return F.array(*out)

    def add(state: Column, addend: Column) -> Column:
        s, error = _two_sum(state["hi"], addend)
        return F.struct(s.alias("hi"), (state["lo"] + error).alias("lo"))

    start = F.struct(F.lit(0.0).alias("hi"), F.lit(0.0).alias("lo"))
    addends = F.flatten(F.transform(F.sort_array(bins, asc=False), pieces))
    return F.aggregate(addends, start, add, lambda s: s["hi"] + s["lo"])


def exact_sums(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    total: str,
    number: str,
    others: Mapping[str, tuple[str, Column]] | None = None,
) -> DataFrame:
    """Per group the exact ``total`` of ``value`` and the ``number`` of values
    (neither null nor NaN). ``others`` names further aggregates of the same scan
    with how their partial results are merged ("sum", "min", "max"). Without keys
    the result is one row, with empty input too. A group without values has a null
    total; infinite values make the total infinite, or NaN if both signs occur."""
    others, keys = dict(others or {}), list(keys)
    x = finite(value)
    wild = F.abs(x) == float("inf")
    given = df.withColumn("_x", F.when(~wild, x)).withColumn("_wild", F.when(wild, x)).withColumn("_bin", bin_of(F.col("_x")))
    partial = with_parts(given).groupBy(*keys, "_bin").agg(
        *[F.sum(c).alias(c) for c in ("_p0", "_p1", "_p2", "_wild")],
        (F.count("_x") + F.count("_wild")).alias("_n"),
        *[made.alias(name) for name, (_, made) in others.items()],
    )
    entry = F.struct(F.col("_bin").alias("bin"), F.col("_p0").alias("p0"), F.col("_p1").alias("p1"), F.col("_p2").alias("p2"))
    whole = partial.groupBy(*keys).agg(
        F.collect_list(F.when(F.col("_p0").isNotNull(), entry)).alias("_bins"),
        F.sum("_wild").alias("_wild"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias(number),
        *[_merged(name, how) for name, (how, _) in others.items()],
    )
    result = F.when(F.col(number) > 0, F.coalesce("_wild", _combined(F.col("_bins"))))
    return whole.select(*keys, result.alias(total), number, *others)


def _merged(name: str, how: str) -> Column:
    merged = MERGES[how](name)
    return (F.coalesce(merged, F.lit(0)) if how == "sum" else merged).alias(name)


def exact_means(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    out: str,
    others: Mapping[str, tuple[str, Column]] | None = None,
) -> DataFrame:
    """As ``exact_sums``, with the mean as ``out``; null without values."""
    summed = exact_sums(df, keys, value, "_total", "_number", others)
    mean = F.col("_total") / F.nullif(F.col("_number"), F.lit(0))
    return summed.select(*keys, mean.alias(out), *(others or {}))


# -------------------------------------------------------- ordered form of doubles
_MANTISSA = 52
_BIAS = 1023


def with_order_key(df: DataFrame, value: Column, out: str) -> DataFrame:
    """Adds a 64-bit integer that sorts as the double does: its own bit pattern,
    found by arithmetic a column at a time, and mirrored for negative numbers.
    NaN is the largest; both zeros are equal; null stays null."""
    size, m, e = F.col("_size"), F.col("_m"), F.col("_e")
    half = F.floor(e / 2).cast("int")
    steps = df.withColumns({"_v": value.cast("double"), "_size": F.abs(value.cast("double"))})
    steps = steps.withColumn("_e", F.floor(F.log2(F.when(size < float("inf"), size))).cast("int"))
    steps = steps.withColumn("_m", size * power_of_two(-half) * power_of_two(half - e))

    def bits_of(exponent: Column, scaled: Column) -> Column:
        return F.lit(1 << _MANTISSA) * (exponent + _BIAS).cast("bigint") + ((scaled - 1) * 2.0**_MANTISSA).cast("bigint")

    bits = (
        F.when(F.isnan("_v"), F.lit((2047 << _MANTISSA) + 1))
        .when(size == float("inf"), F.lit(2047 << _MANTISSA))
        .when(size < 2.0**-1022, (size * 2.0**537 * 2.0**537).cast("bigint"))
        # a rounded logarithm may be one off
        .when(m >= 2, bits_of(e + 1, m / 2))
        .when(m < 1, bits_of(e - 1, m * 2))
        .otherwise(bits_of(e, m))
    )
    steps = steps.withColumn("_bits", F.when(size.isNotNull(), bits))
    mirrored = F.when((F.col("_v") < 0) & ~F.isnan("_v"), -F.col("_bits") - 1).otherwise(F.col("_bits"))
    return steps.select(*df.columns, mirrored.alias(out))


def of_order_key(key: Column) -> Column:
    """The double that ``order_key`` came from."""
    bits = F.when(key < 0, -key - 1).otherwise(key)
    exponent = F.shiftright(bits, _MANTISSA).cast("int")
    mantissa = bits.bitwiseAND(F.lit((1 << _MANTISSA) - 1)).cast("double")
    half = F.floor((exponent - _BIAS) / 2).cast("int")
    normal = (F.lit(1.0) + mantissa * 2.0**-_MANTISSA) * power_of_two(half) * power_of_two(exponent - _BIAS - half)
    special = F.when(mantissa > 0, F.lit(float("nan"))).otherwise(F.lit(float("inf")))
    size = F.when(exponent == 2047, special).when(exponent == 0, mantissa * 2.0**-537 * 2.0**-537).otherwise(normal)
    return F.when(key < 0, -size).otherwise(size)
