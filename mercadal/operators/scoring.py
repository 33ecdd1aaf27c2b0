"""Weighted multi-criteria scores, rankings and weight scenarios.

Scores are long: (alternative, criterion, score). Weights are long as well:
(criterion, weight), and a scenario table adds a scenario column. Weights and
scenarios are written by hand, one row per criterion, and thus broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercadal.functions.scalars import normalised
from mercadal.operators.ranking import distributed_row_number
from mercadal.session import local_table


def weight_table(spark: SparkSession, weights: dict[str, float]) -> DataFrame:
    rows = [(name, float(w)) for name, w in weights.items()]
    return local_table(spark, rows, "criterion string, weight double")


def scenario_table(
    spark: SparkSession, weights: dict[str, float], shifts: dict[str, dict[str, float]]
) -> DataFrame:
    """Every scenario is the base weights plus its shifts per criterion."""
    rows = [
        (scenario, name, float(w) + float(delta.get(name, 0.0)))
        for scenario, delta in shifts.items()
        for name, w in weights.items()
    ]
    return local_table(spark, rows, "scenario string, criterion string, weight double")


def normalised_weights(weights: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Adds ``share`` = weight / sum of the weights (per scenario)."""
    if by:
        sums = weights.groupBy(*by).agg(F.sum("weight").alias("_all"))
        joined = weights.join(F.broadcast(sums), list(by))
    else:
        joined = weights.join(F.broadcast(weights.agg(F.sum("weight").alias("_all"))), how="cross")
    return joined.withColumn("share", normalised(F.col("weight"), F.col("_all"))).drop("_all")


def weighted_scores(
    scores: DataFrame, weights: DataFrame, by: Sequence[str] = ()
) -> DataFrame:
    """Sum of score x weight share per alternative (and scenario)."""
    shares = F.broadcast(normalised_weights(weights, by))
    part = (F.col("score") * F.col("share")).cast("decimal(38,12)")
    return (
        scores.join(shares, "criterion")
        .groupBy(*by, "alternative")
        .agg(F.sum(part).cast("double").alias("total"))
        .withColumn("total", F.round("total", 6))
    )


def rank_scores(totals: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rank by total, best first; equal totals are ordered by alternative."""
    ordered = distributed_row_number(
        totals, [*by, F.desc("total"), F.asc("alternative")], "_rn"
    )
    if not by:
        return ordered.withColumnRenamed("_rn", "rank")
    firsts = ordered.groupBy(*by).agg(F.min("_rn").alias("_first"))
    # one row per hand-written scenario
    joined = ordered.join(F.broadcast(firsts), list(by))
    return joined.withColumn("rank", F.col("_rn") - F.col("_first") + 1).drop("_rn", "_first")


def sensitivity(scores: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Ranking of the alternatives under every weight scenario."""
    return rank_scores(weighted_scores(scores, scenarios, ["scenario"]), ["scenario"])


def score_matrix(
    scores: DataFrame, weights: DataFrame, alternatives: Sequence[str], total: str = "TOTAL"
) -> DataFrame:
    """One row per criterion with its weight share and a column per alternative,
    and a last row with the weighted totals."""
    shares = normalised_weights(weights)
    cells = [
        F.max(F.when(F.col("alternative") == a, F.col("score").cast("double"))).alias(a)
        for a in alternatives
    ]
    body = (
        scores.groupBy("criterion")
        .agg(*cells)
        .join(F.broadcast(shares), "criterion")
        .select("criterion", F.round(F.col("share") * 100, 1).alias("weight_pct"), *alternatives)
    )
    totals = weighted_scores(scores, weights)
    last = totals.agg(
        *[
            F.round(F.max(F.when(F.col("alternative") == a, F.col("total"))), 2).alias(a)
            for a in alternatives
        ]
    ).select(F.lit(total).alias("criterion"), F.lit(100.0).alias("weight_pct"), *alternatives)
    return body.unionByName(last)
