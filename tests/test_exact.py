"""Order-free sums and the ordered form of doubles, against whole-number arithmetic."""

from __future__ import annotations

import math
import random
import struct
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from mercadal.functions.exact import exact_means, exact_sums, of_order_key, with_order_key
from mercadal.session import local_table

EXTREME = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, 1e300, 1.0, -1.0, 16.0]


def doubles(dice, n):
    """Random bit patterns: all exponents, subnormals among them."""
    out = []
    while len(out) < n:
        x = struct.unpack("<d", struct.pack("<Q", dice.getrandbits(64)))[0]
        if math.isfinite(x):
            out.append(x)
    return out


def exact(values):
    return float(sum(map(Fraction, values), Fraction(0)))


@pytest.mark.parametrize("kind", ["money", "tiny", "any", "cancelling", "extreme"])
def test_sums_are_exact_and_free_of_order(spark, kind):
    dice = random.Random(kind)
    values = {
        "money": [dice.randrange(-(10**9), 10**9) / 100 for _ in range(700)],
        "tiny": [4e-7] * 500 + [1e-300] * 9,
        "any": [x * 2.0**-12 for x in doubles(dice, 300)],
        "cancelling": [1e300, 1.0, -1e300, 3e-20, 1e18, -1e18],
        "extreme": [x / 4 for x in EXTREME],
    }[kind]
    seen = set()
    for parts in (1, 3, 17):
        dice.shuffle(values)
        rows = local_table(spark, [("a", v) for v in values] + [("b", None), ("b", float("nan"))], "k string, v double")
        rows = rows.repartition(parts)
        got = {r.k: (r.total, r.n) for r in exact_sums(rows, ["k"], F.col("v"), "total", "n").collect()}
        assert got["b"] == (None, 0) and got["a"][1] == len(values)
        seen.add(struct.pack("<d", got["a"][0]))
    assert len(seen) == 1 and got["a"][0] == exact(values)


def test_sums_of_a_million_small_values(spark):
    rows = spark.range(1_000_000).select(F.lit(4e-7).alias("v"))
    row = exact_sums(rows, [], F.col("v"), "total", "n").first()
    assert (row.total, row.n) == (exact([4e-7] * 10**6), 10**6) and round(row.total, 12) == 0.4


def test_sums_with_infinite_values_and_without_rows(spark):
    inf = float("inf")
    rows = local_table(spark, [("up", inf), ("up", 1.0), ("both", inf), ("both", -inf), ("down", -inf)], "k string, v double")
    got = {r.k: r.total for r in exact_sums(rows, ["k"], F.col("v"), "total", "n").collect()}
    assert got["up"] == inf and got["down"] == -inf and math.isnan(got["both"])
    none = rows.where("k = 'x'")
    assert tuple(exact_sums(none, [], F.col("v"), "total", "n", {"rows": ("sum", F.count(F.lit(1)))}).first()) == (None, 0, 0)
    assert exact_sums(none, ["k"], F.col("v"), "total", "n").count() == 0


def test_means_carry_other_aggregates_of_the_same_scan(spark):
    rows = local_table(spark, [(1, 1e-9), (1, 3e-9), (1, None), (None, 2.0)], "k int, v double")
    others = {"rows": ("sum", F.count(F.lit(1))), "low": ("min", F.min("v")), "high": ("max", F.max("v"))}
    got = {r.k: tuple(r)[1:] for r in exact_means(rows, ["k"], F.col("v"), "m", others).collect()}
    assert got == {1: (2e-9, 3, 1e-9, 3e-9), None: (2.0, 1, 2.0, 2.0)}


def test_order_keys_are_the_bits_and_sort_as_the_numbers(spark):
    dice = random.Random(9)
    values = doubles(dice, 400) + EXTREME + [-x for x in EXTREME] + [float("inf"), -float("inf"), 2.0**-1022, 2.0**52 + 1]
    values += [math.nextafter(2.0**k, s) for k in range(-60, 60, 7) for s in (0, math.inf)]
    rows = local_table(spark, [(v,) for v in values], "v double")
    for r in with_order_key(rows, F.col("v"), "k").withColumn("back", of_order_key(F.col("k"))).collect():
        bits = struct.unpack("<q", struct.pack("<d", abs(r.v)))[0]
        assert r.k == (-bits - 1 if r.v < 0 else bits) and r.back == r.v
    odd = local_table(spark, [(None,), (float("nan"),)], "v double")
    odd = with_order_key(odd, F.col("v"), "k").withColumn("b", of_order_key(F.col("k")))
    (none, nan) = odd.collect()
    assert none.k is None and none.b is None and math.isnan(nan.b) and nan.k > 2047 << 52
