import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from mercadal.operators.ranking import (
    distributed_row_number,
    exact_quantiles,
    quintile,
    quintile_score,
    quintiles_by_measure,
)
from mercadal.session import local_table


def quantile_cut(n):
    """Scores by brute force: bins between interpolated quantiles of 1..n."""
    ranks = pd.Series(range(1, n + 1), dtype="float64")
    return pd.qcut(ranks, 5, labels=[1, 2, 3, 4, 5]).astype(int).tolist()


def test_quintile_equals_quantile_cut(spark):
    sizes = [2, 3, 4, 5, 6, 7, 8, 9, 11, 13, 99, 100, 101, 501, 502, 503, 504]
    pairs = local_table(
        spark, [(n, r) for n in sizes for r in range(1, n + 1)], "n int, r int"
    )
    rows = pairs.withColumn("q", quintile(F.col("r"), F.col("n"))).orderBy("n", "r").collect()
    got = {}
    for row in rows:
        got.setdefault(row.n, []).append(row.q)
    for n in sizes:
        assert got[n] == quantile_cut(n), n
    assert [got[502].count(k) for k in range(1, 6)] == [101, 100, 100, 100, 101]


def test_single_row_scores_one(spark):
    one = local_table(spark, [(7,)], "v int")
    assert quintile_score(one, ["v"], "s").first().s == 1


@pytest.mark.parametrize("partitions", [1, 17])
def test_row_number_with_heavy_ties(spark, partitions):
    rows = spark.range(20_000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.pmod(F.xxhash64("id"), F.lit(50))).alias("v"),
    ).repartition(partitions)
    order = [F.desc("v"), F.asc("id")]
    ranked = distributed_row_number(rows, order, "rn")
    plain = rows.withColumn("want", F.row_number().over(Window.orderBy(*order)))
    wrong = ranked.join(plain.select("id", "want"), "id").where("rn <> want")
    assert ranked.count() == 20_000 and wrong.count() == 0


def test_row_number_puts_nulls_where_the_order_says(spark):
    rows = local_table(spark, [(1, None), (2, 3), (3, 1)], "id int, v int")
    ranked = distributed_row_number(rows, [F.asc_nulls_last("v"), F.asc("id")])
    assert {r.id: r.rn for r in ranked.collect()} == {3: 1, 2: 2, 1: 3}


def test_quintiles_by_measure(spark):
    long = spark.range(30).select(
        F.when(F.col("id") < 10, "a").otherwise("b").alias("m"), F.col("id").alias("v")
    )
    rows = quintiles_by_measure(long, "m", ["v"], "q").orderBy("v").collect()
    assert [r.q for r in rows if r.m == "a"] == quantile_cut(10)
    assert [r.q for r in rows if r.m == "b"] == quantile_cut(20)


def test_exact_quantiles_match_numpy(spark):
    rows = spark.range(9_001).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 5)).alias("g"),
        F.when(F.col("id") % 11 != 0, F.round(F.abs(F.hash("id")) / 1e6, 2)).alias("v"),
    )
    probs = {"q0": 0.0, "q25": 0.25, "q50": 0.5, "q99": 0.99, "q100": 1.0}
    pdf = rows.toPandas()
    groups = exact_quantiles(rows, "v", probs, by=["g"]).collect()
    assert len(groups) == pdf.g.nunique()
    for row in groups:
        values = pdf.v[pdf.g == row.g].dropna()
        for name, p in probs.items():
            assert row[name] == pytest.approx(np.quantile(values, p), rel=1e-12), (row.g, name)
    whole = exact_quantiles(rows, "v", probs).first()
    for name, p in probs.items():
        assert whole[name] == pytest.approx(np.quantile(pdf.v.dropna(), p), rel=1e-12)


def test_exact_quantiles_small_and_empty(spark):
    values = local_table(spark, [(1.0,), (2.0,), (3.0,), (4.0,), (100.0,), (None,)], "v double")
    row = exact_quantiles(values, "v", {"a": 0.25, "b": 0.75}).first()
    assert (row.a, row.b) == (2.0, 4.0)
    assert exact_quantiles(values.where("v > 1000"), "v", {"a": 0.5}).first().a is None
