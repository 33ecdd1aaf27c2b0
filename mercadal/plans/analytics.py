"""Analytical queries over the gold tables, and the data of their charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercadal.functions.scalars import cents, money_mean, money_sum, period_label, thousands
from mercadal.operators.aggregates import (
    behaviour_by,
    pivot_sum,
    running_total,
    share_of_total,
    top_k,
)
from mercadal.operators.ranking import quintiles_by_measure

SEGMENT_BANDS = ((12, "Campeón"), (9, "Leal"), (6, "Potencial"))
LOWEST_SEGMENT = "En Riesgo"


def top_categorias(ventas: DataFrame, k: int = 10) -> DataFrame:
    """Categories by revenue; the mean ticket is the plain mean of the cells."""
    totals = ventas.groupBy("category").agg(
        money_sum(F.col("total_ingresos")).alias("ingresos_totales"),
        F.sum("total_unidades").alias("unidades_totales"),
        F.sum("num_transacciones").alias("num_transacciones"),
        money_mean(F.col("ticket_promedio")).alias("ticket_promedio"),
        F.count_distinct("country").alias("num_paises"),
    )
    return top_k(totals, [F.desc("ingresos_totales"), F.asc("category")], k)


def serie_temporal(ventas: DataFrame) -> DataFrame:
    """Monthly revenue and count with the running revenue."""
    months = ventas.groupBy("year", "month").agg(
        money_sum(F.col("total_ingresos")).alias("ingresos_mes"),
        F.sum("num_transacciones").alias("transacciones_mes"),
    )
    labelled = months.withColumn("periodo", period_label(F.col("year"), F.col("month")))
    return running_total(labelled, ["year", "month"], "ingresos_mes", "ingresos_acum").orderBy(
        "year", "month"
    )


def desempeno_por_pais(ventas: DataFrame) -> DataFrame:
    countries = ventas.groupBy("country").agg(
        money_sum(F.col("total_ingresos")).alias("ingresos_totales"),
        F.sum("num_transacciones").alias("num_transacciones"),
        cents(money_mean(F.col("ticket_promedio"))).alias("ticket_promedio"),
    )
    return share_of_total(countries, "ingresos_totales", "pct_ingresos").orderBy(
        F.desc_nulls_last("ingresos_totales"), "country"
    )


def pais_por_categoria(ventas: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Country x category revenue, empty cells 0."""
    cells = ventas.withColumn("_v", F.col("total_ingresos").cast("decimal(24,6)"))
    table = pivot_sum(cells, "country", "category", categories, "_v")
    rest = [c for c in table.columns if c != "country"]
    return table.select("country", *[F.col(f"`{c}`").cast("double").alias(c) for c in rest])


def comportamiento_dispositivos(events: DataFrame) -> DataFrame:
    """Sessions, durations and purchases per device and browser."""
    rows = behaviour_by(
        events, ["device", "browser"], "session_id", "duration_sec", "event_type", "purchase"
    )
    return rows.withColumnsRenamed(
        {
            "num_sessions": "num_sesiones",
            "unique_sessions": "sesiones_unicas",
            "mean_duration": "dur_media_seg",
            "max_duration": "dur_max_seg",
            "num_purchases": "num_compras",
        }
    )


def segment(total):
    """Name of the band an R + F + M total falls in."""
    column = None
    for least, name in SEGMENT_BANDS:
        test = total >= least
        column = F.when(test, name) if column is None else column.when(test, name)
    return column.otherwise(LOWEST_SEGMENT)


def rfm_scores(profiles: DataFrame) -> DataFrame:
    """Quintile scores for recency, frequency and spend, their sum and segment.

    The three measures are stacked and ranked in one range sort. Equal values
    rank by spend (highest first) and user, the order of the profile table.
    """
    columns = ["user_id", "gasto_total", "num_compras", "ultima_compra"]
    stacked = profiles.select(
        *columns, F.explode(F.array(F.lit("R"), F.lit("F"), F.lit("M"))).alias("measure")
    )
    # one sort column per type; within a measure only its own is set
    stacked = stacked.withColumns(
        {
            "_moment": F.when(F.col("measure") == "R", F.col("ultima_compra")),
            "_value": F.when(F.col("measure") == "F", F.col("num_compras").cast("double")).when(
                F.col("measure") == "M", F.col("gasto_total")
            ),
        }
    )
    order = ["_moment", "_value", F.desc("gasto_total"), F.asc("user_id")]
    scored = quintiles_by_measure(stacked, "measure", order, "score")

    def score_of(name: str):
        return F.max(F.when(F.col("measure") == name, F.col("score")))

    users = scored.groupBy("user_id").agg(
        F.max("ultima_compra").alias("ultima_compra"),
        F.max("num_compras").alias("num_compras"),
        F.max("gasto_total").alias("gasto_total"),
        score_of("R").alias("R_score"),
        score_of("F").alias("F_score"),
        score_of("M").alias("M_score"),
    )
    total = F.col("R_score") + F.col("F_score") + F.col("M_score")
    return users.withColumn("RFM_total", total).withColumn("segmento", segment(F.col("RFM_total")))


def rfm_segments(scores: DataFrame) -> DataFrame:
    """Users, mean spend and mean purchases per segment."""
    return (
        scores.groupBy("segmento")
        .agg(
            F.count("user_id").alias("num_usuarios"),
            cents(money_mean(F.col("gasto_total"))).alias("gasto_medio"),
            cents(money_mean(F.col("num_compras"))).alias("compras_medias"),
        )
        .orderBy(F.desc_nulls_last("gasto_medio"))
    )


def segment_counts(scores: DataFrame) -> DataFrame:
    """Users per segment with their share, largest first."""
    sizes = scores.groupBy("segmento").agg(F.count(F.lit(1)).alias("num_usuarios"))
    return share_of_total(sizes, "num_usuarios", "pct_usuarios", 1).orderBy(
        F.desc("num_usuarios"), "segmento"
    )


def chart_values(table: DataFrame, label: str, value: str) -> DataFrame:
    """Label and value in thousands, the data behind a bar or line chart."""
    return table.select(label, thousands(F.col(value)).alias(f"{value}_miles"))
