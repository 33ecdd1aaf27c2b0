"""The order star (orders, lineitem, customer, part, ...) in the shapes the
zone tables and reports expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Closed domains of the star.
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
STEPS = ["view", "click", "signup", "purchase"]

# Stored schemas. Reading with them needs no footer to be opened up front.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
    "props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def numbered(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table with the file and row position of every row."""
    return table(spark, folder, name).select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_row_id"),
    )


PLACE = ["_file", "_row_id"]


def places(spark: SparkSession, folder: str) -> DataFrame:
    """Nations with their region: 25 rows by definition of the schema."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return nation.join(
        F.broadcast(region), nation["n_regionkey"] == region["r_regionkey"]
    ).select("n_nationkey", "n_name", "r_name")


def line_total():
    """Price less discount, rounded half-up to cents in whole-number arithmetic."""
    price = F.rint(F.col("l_extendedprice") * 100).cast("bigint")
    kept = F.lit(100) - F.rint(F.col("l_discount") * 100).cast("bigint")
    exact = price * kept  # ten-thousandths
    cents = F.floor((F.abs(exact) + F.lit(50)) / F.lit(100)) * F.signum(exact)
    return cents / F.lit(100.0)


def located_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the nation and region of their customer."""
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    return orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).join(
        F.broadcast(places(spark, folder)), F.col("c_nationkey") == F.col("n_nationkey")
    )


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumns({"year": F.year("date"), "month": F.month("date")})


def line_transactions(spark: SparkSession, folder: str, country: str = "n_name") -> DataFrame:
    """Order lines as transactions; the category is the part type."""
    lines = table(spark, folder, "lineitem")
    part = table(spark, folder, "part").select("p_partkey", F.col("p_type").alias("category"))
    placed = located_orders(spark, folder).select(
        "o_orderkey", F.col("o_orderdate").alias("date"), F.col(country).alias("country")
    )
    joined = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).join(
        placed, F.col("l_orderkey") == F.col("o_orderkey")
    )
    return _dated(
        joined.select(
            F.col("l_orderkey").alias("transaction_id"),
            "category",
            "country",
            "date",
            line_total().alias("amount"),
            F.col("l_quantity").cast("int").alias("quantity"),
        )
    )


def order_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as transactions; the category is the priority."""
    return _dated(
        located_orders(spark, folder).select(
            F.col("o_orderkey").alias("transaction_id"),
            F.col("o_orderpriority").alias("category"),
            F.col("n_name").alias("country"),
            F.col("o_orderdate").alias("date"),
            F.col("o_totalprice").alias("amount"),
            F.lit(1).alias("quantity"),
        )
    )


def user_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per user; no dimension is needed."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderpriority").alias("category"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("date"),
    )


def session_key():
    """A user's events of one day are a session."""
    day = F.col("ts").cast("date").cast("string")
    return F.concat(F.col("user_id").cast("string"), F.lit("#"), day)


def web_events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id",
        "user_id",
        session_key().alias("session_id"),
        "event_type",
        F.hour("ts").alias("hour"),
        F.col("value").alias("duration_sec"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("nombre"),
        F.col("p_type").alias("categoria"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("precio_unitario"),
    )


def line_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as sales of parts, without region and channel."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_partkey").alias("producto_id"),
        F.col("l_quantity").cast("int").alias("cantidad"),
        F.col("l_shipdate").cast("date").alias("fecha"),
        line_total().alias("total"),
    )


def order_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as sales; the channel is the priority."""
    return located_orders(spark, folder).select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").cast("date").alias("fecha"),
        F.col("r_name").alias("region"),
        F.col("o_orderpriority").alias("canal"),
        F.col("o_totalprice").alias("total"),
    )


def placed_line_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as sales with the region and channel of their order."""
    lines = table(spark, folder, "lineitem")
    placed = located_orders(spark, folder).select(
        "o_orderkey",
        F.col("o_orderdate").cast("date").alias("fecha"),
        F.col("r_name").alias("region"),
        F.col("o_orderpriority").alias("canal"),
    )
    return lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("id"),
        F.col("l_partkey").alias("producto_id"),
        F.col("l_quantity").cast("int").alias("cantidad"),
        "fecha",
        "region",
        "canal",
        line_total().alias("total"),
    )
