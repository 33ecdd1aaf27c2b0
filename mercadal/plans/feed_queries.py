"""Queries over feeds made of the given tables: stamps in several layouts, and
rows with planted faults for the rules to find."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercadal.functions.layouts import feed_layouts
from mercadal.functions.scalars import stamp_text
from mercadal.operators import quality
from mercadal.operators import rules as R
from mercadal.operators.faults import Copies, Fault, with_faults
from mercadal.plans import star
from mercadal.plans.star import table
from mercadal.schemas import ORDINAL, product_rules, sales_rules

ISO = r"^([0-9]{4})-([0-9]{2})-([0-9]{2}) (.*)$"


def text_feeds(spark: SparkSession, sf: str) -> DataFrame:
    """(feed, stamp): ship dates, one layout per return flag, among them strays
    in another layout, blanks and words; and event times."""
    shipped = stamp_text(F.col("l_shipdate"))
    written = (
        F.when(F.col("l_linenumber") == 7, F.lit("sin fecha"))
        .when(F.col("l_linenumber") == 6, F.lit(" "))
        .when(F.col("l_linenumber") == 5, F.regexp_replace(shipped, ISO, "$1/$2/$3"))
        .when(F.col("l_returnflag") == "A", F.regexp_replace(shipped, ISO, "$3/$2/$1 $4"))
        .when(F.col("l_returnflag") == "N", F.regexp_replace(shipped, ISO, "$1-$2-$3T$4"))
        .otherwise(F.regexp_replace(shipped, ISO, "$2/$3/$1"))
    )
    lines = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("feed"), written.alias("stamp"))
    seen = F.regexp_replace(stamp_text(F.col("ts")), ISO, "$1/$2/$3 $4")
    return lines.unionByName(table(spark, sf, "events").select(F.lit("events").alias("feed"), seen.alias("stamp")))


def stamp_layouts(spark, sf):
    """The layout found for each feed and what it reads of it."""
    feeds = text_feeds(spark, sf)
    found = feed_layouts(feeds, "stamp", ["feed"])
    layout = name = F.lit(None)
    for (feed,), its in found.items():
        own = F.col("feed").eqNullSafe(F.lit(feed))
        layout = F.when(own, its.stamp(F.col("stamp"))).otherwise(layout)
        name = F.when(own, F.lit(its.name)).otherwise(name)
    read = feeds.select("feed", name.cast("string").alias("layout"), layout.cast("timestamp_ntz").alias("at"))
    return read.groupBy("feed", "layout").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("at").alias("n_stamps"),
        F.min("at").alias("first_stamp"),
        F.max("at").alias("last_stamp"),
    )


# ------------------------------------------------------------------ planted faults
EVENT_FAULTS = (
    Fault("event_type", 53, 5),
    Fault("value", 61, 7, -3.5),
    Fault("event_type", 67, 11, "teleport"),
    Fault("ts", 71, 13, "2030-01-01 00:00:00"),
    Fault("user_id", 73, 17, -9),
    Fault("props", 79, 19, "{}"),
    Fault("value", 83, 23, 1e9),
    Copies(89, 29, 2),
)
SALE_FAULTS = (
    Fault("total", 53, 5),
    Fault("region", 59, 3),
    Fault("producto_id", 61, 7, -1),
    Fault("cantidad", 67, 11, 0),
    Fault("cantidad", 71, 13, -4),
    Copies(73, 17),
)
PRODUCT_FAULTS = (
    Fault("nombre", 17, 5),
    Fault("precio_unitario", 19, 7, 0),
    Fault("precio_unitario", 23, 11, "-3.50"),
    Copies(29, 13, 3),
)


def faulty(rows: DataFrame, key, faults) -> DataFrame:
    """``rows`` of ``star.numbered`` with faults; copies stand behind the rows
    themselves, so of equal keys the row itself is first in file order."""
    return with_faults(rows, key, faults, "_block_start")


def _faulty_events(spark, sf) -> DataFrame:
    return faulty(star.numbered(spark, sf, "events"), F.col("event_id"), EVENT_FAULTS)


def _judged_events(spark, sf) -> quality.QualityResult:
    rules = [
        R.not_null("R01", ["event_id", "user_id", "event_type", "ts"], "required field is null"),
        R.first_occurrence("R02", ["event_id"], ORDINAL, "repeated event_id"),
        R.out_of_range("R03", "value", lambda c: c <= 1, "value not above one"),
        R.allowed("R04", "event_type", star.STEPS, "event_type outside the vocabulary"),
        R.not_future("R05", "ts", "ts after the reference instant"),
        R.references("R06", "user_id", "users", "c_custkey", "user without positive balance"),
        R.matches("R07", "props", r'^\{"k": [0-9]{2}\}$', "props not a two-digit k"),
        R.iqr_outlier("R08", "value", "value above Q3 + 3 IQR"),
    ]
    users = table(spark, sf, "customer").where("c_acctbal > 0")
    return quality.apply_rules(_faulty_events(spark, sf), rules, "2024-01-25 00:00:00", refs={"users": users})


def faulty_event_report(spark, sf):
    """Every rule against events with planted faults of its kind."""
    return _judged_events(spark, sf).report


def faulty_event_rows(spark, sf):
    """The events that stay, with the number of the copy (0: the row itself)."""
    kept = _judged_events(spark, sf).clean.withColumnRenamed("_block_start", "copy")
    return kept.drop("_file", "_row_id")


def faulty_star_report(spark, sf):
    """The constraints of the product and sales tables, null, key, foreign key
    and check, on rows that break them."""
    products = star.products(spark, sf)
    numbered = star.numbered(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("nombre"), F.col("p_type").alias("categoria"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("precio_unitario"), *star.PLACE,
    )
    placed = star.located_orders(spark, sf).select(
        "o_orderkey", F.col("r_name").alias("region"), F.col("o_orderpriority").alias("canal")
    )
    lines = star.numbered(spark, sf, "lineitem")
    sales = lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey"), "left").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_partkey").alias("producto_id"),
        F.col("l_quantity").cast("int").alias("cantidad"), F.col("l_shipdate").cast("date").alias("fecha"),
        "region", "canal", star.line_total().alias("total"), *star.PLACE,
    )
    judged = {
        "productos": (numbered, PRODUCT_FAULTS, product_rules(), {}),
        "ventas": (sales, SALE_FAULTS, sales_rules(), {"productos": products}),
    }
    reports = [
        quality.apply_rules(faulty(rows, F.col("id"), faults), rules, None, refs).report.select(F.lit(name).alias("tabla"), "*")
        for name, (rows, faults, rules, refs) in judged.items()
    ]
    return reduce(DataFrame.unionByName, reports)
