"""Synthetic feeds with known faults.

Every draw is a hash of (row id, seed, draw number), so a value depends
neither on partitioning nor on which task computes it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercadal.functions.scalars import labelled_id
from mercadal.schemas import (
    BROWSERS,
    CATEGORIES,
    COUNTRIES,
    DEVICES,
    EVENT_COLUMNS,
    EVENT_TYPES,
    PAYMENT_METHODS,
    PRODUCTS,
    STATUSES,
    TRANSACTION_COLUMNS,
)
from mercadal.session import local_table
from mercadal.sources.writers import load_once

# Fixed values of the feeds.
BASE_DAY = "2024-01-01"
FUTURE_DAY = "2026-12-31"
USERS, CATALOG_SIZE, SESSIONS, PAGES = 500, 200, 2000, 50

# Fixed values of the sales star.
PRODUCT_LIST = [
    ("Laptop Pro 15", "Electrónica", 899990),
    ("Auriculares Bluetooth", "Electrónica", 49990),
    ("Smartwatch X200", "Electrónica", 149990),
    ("Tablet 10 pulgadas", "Electrónica", 299990),
    ("Polera de algodón", "Ropa", 12990),
    ("Zapatillas Running", "Deportes", 89990),
    ("Chaqueta impermeable", "Ropa", 59990),
    ("Arroz integral 5 kg", "Alimentos", 5490),
    ("Aceite de oliva 1 L", "Alimentos", 7990),
    ("Silla ergonómica", "Hogar", 199990),
    ("Lámpara LED escritorio", "Hogar", 29990),
    ("Bicicleta de montaña", "Deportes", 499990),
    ("Mochila táctica 30 L", "Deportes", 69990),
    ("Hervidor eléctrico", "Hogar", 24990),
    ("Jeans slim fit", "Ropa", 39990),
]
REGIONS = ["RM", "Valparaíso", "Biobío", "Araucanía", "Los Lagos", "Antofagasta"]
CHANNEL_WEIGHTS = [("online", 0.5), ("tienda", 0.35), ("b2b", 0.15)]
DISCOUNTS = [0.0, 0.05, 0.10, 0.15]


class Draws:
    """Numbered uniform draws for the row in column ``id``."""

    def __init__(self, seed: int):
        self.seed, self.count = seed, 0

    def uniform(self) -> Column:
        self.count += 1
        bits = F.xxhash64(F.col("id"), F.lit(self.seed), F.lit(self.count))
        return F.pmod(bits, F.lit(1 << 52)) / F.lit(float(1 << 52))

    def chance(self, p: float) -> Column:
        return self.uniform() < F.lit(p)

    def integer(self, low: int, high: int) -> Column:
        return (F.floor(self.uniform() * F.lit(high - low + 1)) + F.lit(low)).cast("int")

    def choice(self, values: Sequence) -> Column:
        listed = F.array(*[F.lit(v) for v in values])
        return F.element_at(listed, self.integer(1, len(values)))

    def between(self, low: float, high: float) -> Column:
        return F.round(F.lit(low) + self.uniform() * F.lit(high - low), 2)

    def day(self, start: str, span: int) -> Column:
        day = F.date_add(F.lit(start).cast("date"), self.integer(0, span))
        return F.concat(day.cast("string"), F.lit(" 00:00:00"))

    def weighted(self, pairs: Sequence[tuple[str, float]]) -> Column:
        spot, reached, column = self.uniform(), 0.0, None
        for name, weight in pairs[:-1]:
            reached += weight
            test = spot < F.lit(reached)
            column = F.when(test, name) if column is None else column.when(test, name)
        return column.otherwise(pairs[-1][0])


def _earlier(draws: Draws) -> Column:
    """Row number of some earlier row (the row itself when it is the first)."""
    return F.floor(draws.uniform() * F.col("id")).cast("bigint")


def synthetic_transactions(
    spark: SparkSession, n: int, seed: int = 42, id_width: int = 6, with_truth: bool = False
) -> DataFrame:
    """Transactions with about 1 % repeated ids, 2 % empty users, 1.5 % foreign
    categories and payment methods, 2 % negative amounts, 1 % negative
    quantities, 1 % future dates and 1 % empty countries."""
    d = Draws(seed)
    repeated = d.chance(0.01) & (F.col("id") > 0)
    no_user, no_country = d.chance(0.02), d.chance(0.01)
    bad_category, bad_payment = d.chance(0.015), d.chance(0.015)
    bad_amount, bad_quantity, future = d.chance(0.02), d.chance(0.01), d.chance(0.01)
    number = F.when(repeated, _earlier(d)).otherwise(F.col("id"))
    rows = spark.range(n).select(
        labelled_id("TXN-", number, id_width).alias("transaction_id"),
        F.when(~no_user, labelled_id("USR-", d.integer(1, USERS), 4)).alias("user_id"),
        labelled_id("PRD-", d.integer(1, CATALOG_SIZE), 4).alias("product_id"),
        F.when(bad_category, "Categoría_Inválida")
        .otherwise(d.choice(CATEGORIES))
        .alias("category"),
        F.when(bad_amount, d.between(-500.0, -1.0))
        .otherwise(d.between(1.0, 2000.0))
        .alias("amount"),
        F.when(bad_quantity, -d.integer(1, 5)).otherwise(d.integer(1, 10)).alias("quantity"),
        F.when(future, d.day(FUTURE_DAY, 200)).otherwise(d.day(BASE_DAY, 365)).alias("date"),
        F.when(bad_payment, "criptomoneda")
        .otherwise(d.choice(PAYMENT_METHODS))
        .alias("payment_method"),
        d.choice(STATUSES).alias("status"),
        F.when(~no_country, d.choice(COUNTRIES)).alias("country"),
        bad_category.alias("_bad_category"),
        bad_payment.alias("_bad_payment"),
        bad_amount.alias("_bad_amount"),
        bad_quantity.alias("_bad_quantity"),
        future.alias("_future"),
        repeated.alias("_repeated"),
    )
    return rows if with_truth else rows.select(*TRANSACTION_COLUMNS)


def synthetic_events(
    spark: SparkSession, n: int, seed: int = 43, id_width: int = 7, with_truth: bool = False
) -> DataFrame:
    """Events with about 0.5 % repeated ids, 3 % null users, 1 % foreign types,
    2 % null pages, 0.8 % future stamps, 1.5 % negative durations and 2 %
    users unknown to the transactions."""
    d = Draws(seed)
    repeated = d.chance(0.005) & (F.col("id") > 0)
    no_user, stranger = d.chance(0.03), d.chance(0.02)
    bad_type, no_page = d.chance(0.01), d.chance(0.02)
    future, bad_duration = d.chance(0.008), d.chance(0.015)
    number = F.when(repeated, _earlier(d)).otherwise(F.col("id"))
    rows = spark.range(n).select(
        labelled_id("EVT-", number, id_width).alias("event_id"),
        F.when(stranger, labelled_id("USR-", d.integer(9000, 9999), 4))
        .when(~no_user, labelled_id("USR-", d.integer(1, USERS), 4))
        .alias("user_id"),
        labelled_id("SES-", d.integer(1, SESSIONS), 5).alias("session_id"),
        F.when(bad_type, "invalid_event").otherwise(d.choice(EVENT_TYPES)).alias("event_type"),
        F.when(~no_page, F.concat(F.lit("/page-"), d.integer(1, PAGES))).alias("page"),
        F.when(future, d.day(FUTURE_DAY, 100)).otherwise(d.day(BASE_DAY, 365)).alias("timestamp"),
        d.choice(DEVICES).alias("device"),
        d.choice(BROWSERS).alias("browser"),
        F.when(bad_duration, d.between(-60.0, -0.1))
        .otherwise(d.between(0.5, 600.0))
        .alias("duration_sec"),
        bad_type.alias("_bad_type"),
        bad_duration.alias("_bad_duration"),
        future.alias("_future"),
        stranger.alias("_stranger"),
        (no_user & ~stranger).alias("_no_user"),
        repeated.alias("_repeated"),
    )
    return rows if with_truth else rows.select(*EVENT_COLUMNS)


def product_dimension(spark: SparkSession) -> DataFrame:
    """The 15 products with their list price; ids follow the list."""
    rows = [
        (number, name, category, price)
        for number, (name, category, price) in enumerate(PRODUCT_LIST, start=1)
    ]
    plain = local_table(spark, rows, "id int, nombre string, categoria string, precio int")
    return plain.select(
        "id", "nombre", "categoria",
        F.col("precio").cast(PRODUCTS["precio_unitario"].dataType).alias("precio_unitario"),
    )


def synthetic_sales(spark: SparkSession, n: int, seed: int = 44) -> DataFrame:
    """Sales of the fixed products in 2024; total = quantity x price less a
    discount, rounded to cents. The price list has 15 rows and is broadcast."""
    d = Draws(seed)
    drawn = spark.range(n).select(
        (F.col("id") + 1).cast("int").alias("sale_id"),
        d.integer(1, len(PRODUCT_LIST)).alias("producto_id"),
        d.integer(1, 10).cast("smallint").alias("cantidad"),
        d.choice(DISCOUNTS).cast("decimal(4,2)").alias("descuento"),
        F.date_add(F.lit(BASE_DAY).cast("date"), d.integer(0, 365)).alias("fecha"),
        d.choice(REGIONS).alias("region"),
        d.weighted(CHANNEL_WEIGHTS).alias("canal"),
    )
    prices = product_dimension(spark).select(F.col("id").alias("producto_id"), "precio_unitario")
    total = F.round(
        F.col("cantidad") * F.col("precio_unitario") * (F.lit(1) - F.col("descuento")), 2
    )
    return drawn.join(F.broadcast(prices), "producto_id").select(
        F.col("sale_id").alias("id"), "producto_id", "cantidad", "fecha", "region", "canal",
        total.cast("decimal(12,2)").alias("total"),
    )


def write_star(spark: SparkSession, folder: str, n: int, seed: int = 44) -> dict[str, DataFrame]:
    """Products and sales as Parquet tables; tables already loaded are kept."""
    products = load_once(
        product_dimension(spark).withColumn("creado_en", F.current_timestamp()),
        f"{folder}/productos",
    )
    sales = load_once(
        synthetic_sales(spark, n, seed).withColumn("registrado_en", F.current_timestamp()),
        f"{folder}/transacciones",
    )
    return {"productos": products, "transacciones": sales}
