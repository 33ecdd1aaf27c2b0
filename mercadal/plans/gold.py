"""The three gold tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercadal.functions.exact import exact_means
from mercadal.functions.scalars import cents, money_mean, money_sum, utc_now_text
from mercadal.operators.aggregates import conversion_funnel, without_null_keys
from mercadal.schemas import FUNNEL_STEPS

SALES_KEYS = ["category", "year", "month", "country"]


def ventas_categoria_mes(transactions: DataFrame) -> DataFrame:
    """Revenue, units, count and mean ticket per category, month and country."""
    return (
        without_null_keys(transactions, SALES_KEYS)
        .groupBy(*SALES_KEYS)
        .agg(
            cents(money_sum(F.col("amount"))).alias("total_ingresos"),
            F.sum("quantity").alias("total_unidades"),
            F.count("transaction_id").alias("num_transacciones"),
            cents(money_mean(F.col("amount"))).alias("ticket_promedio"),
        )
    )


def compras_por_usuario(transactions: DataFrame) -> DataFrame:
    return (
        without_null_keys(transactions, ["user_id"])
        .groupBy("user_id")
        .agg(
            F.count("transaction_id").alias("num_compras"),
            cents(money_sum(F.col("amount"))).alias("gasto_total"),
            cents(money_mean(F.col("amount"))).alias("gasto_promedio"),
            F.count_distinct("category").alias("categorias_unicas"),
            F.min("date").alias("primera_compra"),
            F.max("date").alias("ultima_compra"),
        )
    )


def actividad_por_usuario(events: DataFrame) -> DataFrame:
    """Events, sessions and mean duration per user. Durations are measurements of
    any size, so they are added up exactly; sessions are counted beside that."""
    events = without_null_keys(events, ["user_id"])
    sessions = events.groupBy("user_id").agg(F.count_distinct("session_id").alias("sesiones_unicas"))
    lasting = exact_means(events, ["user_id"], F.col("duration_sec"), "_mean", {"num_eventos": ("sum", F.count("event_id"))})
    return lasting.join(sessions, "user_id").select(
        "user_id", "num_eventos", "sesiones_unicas", cents(F.col("_mean")).alias("dur_media_seg")
    )


def perfil_usuarios(transactions: DataFrame, events: DataFrame) -> DataFrame:
    """Purchases per user with the web activity of the same user, if any.

    Both sides are one row per user before they meet, so no user is hot.
    """
    return compras_por_usuario(transactions).join(
        actividad_por_usuario(events), "user_id", "left"
    )


def funnel(events: DataFrame, steps: Sequence[str] = tuple(FUNNEL_STEPS)) -> DataFrame:
    rows = conversion_funnel(events, steps, "session_id", "event_type")
    return rows.select(
        F.col("step").alias("paso"),
        F.col("sessions").alias("sesiones"),
        F.col("pct_of_total").alias("pct_del_total"),
        F.col("previous_sessions").alias("sesiones_previas"),
        F.col("step_rate").alias("tasa_conversion_paso"),
    )


def stamped(table: DataFrame) -> DataFrame:
    """Adds the generation stamp gold tables carry on disk."""
    return table.withColumn("_generated_at", utc_now_text())


def sorted_sales(table: DataFrame) -> DataFrame:
    return table.orderBy("year", "month", F.desc_nulls_last("total_ingresos"), "category", "country")


def sorted_profiles(table: DataFrame) -> DataFrame:
    return table.orderBy(F.desc_nulls_last("gasto_total"), "user_id")
