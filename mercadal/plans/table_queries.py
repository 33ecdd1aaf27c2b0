"""Every operator as a query over the given tables: ``(spark, folder) -> frame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercadal.functions.exact import exact_sums
from mercadal.functions.kernel import trig_kernel
from mercadal.functions.scalars import (
    MONEY_DIGITS,
    decimal_total,
    labelled_id,
    lenient_number,
    lenient_timestamp,
    money_sum,
    stamp_text,
)
from mercadal.operators import aggregates, joins, quality, ranking, scaling, scoring
from mercadal.operators import rules as R
from mercadal.plans import analytics, gold, governance, sales, star
from mercadal.plans.feed_queries import faulty_event_report, faulty_event_rows, faulty_star_report, stamp_layouts
from mercadal.plans.pipeline import PipelineConfig, run_pipeline, together
from mercadal.plans.star import table
from mercadal.schemas import RULE_NAMES, TRANSACTION_FEED, all_text, event_rules, transaction_rules
from mercadal.session import local_table, scratch_path
from mercadal.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]

EVENTS_AS_OF = "2024-01-25 00:00:00"
LINES_AS_OF = "2001-01-01 00:00:00"


# ------------------------------------------------------------------ gold tables
def sales_by_category_month(spark, sf):
    return gold.ventas_categoria_mes(star.line_transactions(spark, sf))


def top_categories(spark, sf):
    return analytics.top_categorias(sales_by_category_month(spark, sf))


def country_category_pivot(spark, sf):
    cells = gold.ventas_categoria_mes(star.line_transactions(spark, sf, "r_name"))
    return analytics.pais_por_categoria(cells, star.PART_TYPES)


def _order_cells(spark, sf):
    return gold.ventas_categoria_mes(star.order_transactions(spark, sf))


def monthly_running_total(spark, sf):
    return analytics.serie_temporal(_order_cells(spark, sf))


def monthly_chart(spark, sf):
    series = analytics.serie_temporal(_order_cells(spark, sf))
    return analytics.chart_values(series, "periodo", "ingresos_mes")


def country_share(spark, sf):
    return analytics.desempeno_por_pais(_order_cells(spark, sf))


def user_profile(spark, sf):
    return gold.perfil_usuarios(star.user_transactions(spark, sf), star.web_events(spark, sf))


def conversion_funnel(spark, sf):
    return gold.funnel(star.web_events(spark, sf), star.STEPS)


def behaviour_by_device(spark, sf):
    return aggregates.behaviour_by(
        star.web_events(spark, sf),
        ["event_type", "hour"],
        "session_id",
        "duration_sec",
        "event_type",
        "purchase",
    )


# ----------------------------------------------------------------- segmentation
def rfm_scores(spark, sf):
    return analytics.rfm_scores(gold.compras_por_usuario(star.user_transactions(spark, sf)))


def rfm_segments(spark, sf):
    return analytics.rfm_segments(rfm_scores(spark, sf))


def segment_counts(spark, sf):
    return analytics.segment_counts(rfm_scores(spark, sf))


def order_price_rank(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return ranking.distributed_row_number(
        orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], "price_rank"
    )


def supplier_balance_quintile(spark, sf):
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_acctbal")
    return ranking.quintile_score(suppliers, ["s_acctbal", "s_suppkey"], "score")


# ----------------------------------------------------------------- data quality
def star_event_rules() -> list[R.Rule]:
    return [
        R.not_null("R01", ["event_id", "user_id", "event_type", "ts"], "required field is null"),
        R.first_occurrence("R02", ["event_id"], star.PLACE, "repeated event_id"),
        R.out_of_range("R03", "value", lambda c: c <= 1, "value not above one"),
        R.allowed("R04", "event_type", star.STEPS, "event_type outside the vocabulary"),
        R.not_future("R05", "ts", "ts after the reference instant"),
        R.references("R06", "user_id", "users", "c_custkey", "user without positive balance"),
        R.matches("R07", "props", r'^\{"k": [0-9]{2}\}$', "props not a two-digit k"),
        R.iqr_outlier("R08", "value", "value above Q3 + 3 IQR"),
    ]


def _solvent_users(spark, sf):
    return table(spark, sf, "customer").where("c_acctbal > 0")


def _event_quality(spark, sf):
    return quality.apply_rules(
        star.numbered(spark, sf, "events"),
        star_event_rules(),
        EVENTS_AS_OF,
        refs={"users": _solvent_users(spark, sf)},
        stats_column="value",
    )


def dq_report_events(spark, sf):
    return _event_quality(spark, sf).report


def dq_clean_events(spark, sf):
    return _event_quality(spark, sf).clean.drop(*star.PLACE)


def dq_stats(spark, sf):
    stats = _event_quality(spark, sf).stats
    return stats.withColumn("mean_value", F.round("mean_value", 6))


def tiny_sums(spark, sf):
    """Sums of values far below a cent, with as much of either sign taken off
    again: what is left is the sum of the tiny values alone."""
    lines = table(spark, sf, "lineitem").select(
        "l_returnflag",
        F.explode(F.array(F.col("l_discount") / 1e7, F.lit(1e18), F.lit(-1e18), F.lit(float("nan")))).alias("v"),
    )
    sums = exact_sums(lines, ["l_returnflag"], F.col("v"), "total", "n")
    return sums.select("l_returnflag", F.round("total", 15).alias("total"), "n")


def star_line_rules() -> list[R.Rule]:
    key = ["l_orderkey", "l_linenumber"]
    return [
        R.not_null("R01", [*key, "l_extendedprice"], "required field is null"),
        R.first_occurrence("R02", key, star.PLACE, "repeated order line"),
        R.out_of_range("R03", "l_quantity", lambda c: c < 5, "quantity below five"),
        R.allowed("R04", "l_returnflag", ["A", "N"], "returnflag outside the vocabulary"),
        R.not_future("R05", "l_shipdate", "shipped after the reference instant"),
        R.references("R06", "l_suppkey", "suppliers", "s_suppkey", "unknown supplier"),
        R.iqr_outlier("R08", "l_extendedprice", "price above Q3 + 0.4 IQR", 0.4),
    ]


def _line_quality(spark, sf, stats_column=None):
    suppliers = table(spark, sf, "supplier").where("s_acctbal > 0")
    lines = star.numbered(spark, sf, "lineitem")
    return quality.apply_rules(
        lines, star_line_rules(), LINES_AS_OF, refs={"suppliers": suppliers}, stats_column=stats_column
    )


def dq_report_lineitem(spark, sf):
    return _line_quality(spark, sf).report


def dq_clean_lineitem(spark, sf):
    """Lines that pass every rule; of repeated lines the first in the file, by content."""
    return _line_quality(spark, sf).clean.drop(*star.PLACE)


def quality_document(spark, sf):
    """Rules and statistics of events and order lines as one nested JSON
    document, written and read back to one row per data set and rule."""
    results = {
        "eventos": _event_quality(spark, sf).stored(),
        "lineas": _line_quality(spark, sf, "l_extendedprice").stored(),
    }
    document = writers.quality_document(
        {name: result.report for name, result in results.items()},
        {name: result.stats for name, result in results.items()},
    )
    path = scratch_path(spark, "reporte_calidad")
    writers.write_jsonl(document, path)
    rows = readers.read_nested(spark, path, document.schema, "conjuntos", "reglas")
    return rows.select(
        "dataset", *[f"estadisticas.{c}" for c in ("rows_in", "rows_out", "min_value", "max_value", "reject_pct")],
        F.round("estadisticas.mean_value", 4).alias("mean_value"), *writers.REPORT_FIELDS,
    )


def dedup_lineitem_first(spark, sf):
    lines = table(spark, sf, "lineitem")
    key = ["l_orderkey", "l_linenumber"]
    rest = [c for c in lines.columns if c not in key]
    return quality.first_rows(lines, key, rest)


def constraint_report(spark, sf):
    """NOT NULL, key, CHECK and foreign-key constraints of the sales star."""
    lines = star.numbered(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
        F.col("l_partkey").alias("producto_id"),
        F.col("l_quantity").cast("int").alias("cantidad"),
        star.line_total().alias("total"),
        *star.PLACE,
    )
    parts = star.products(spark, sf).where("precio_unitario >= 950")
    constraints = [
        R.not_null("NN", ["id", "producto_id", "cantidad", "total"], "null in sale"),
        R.first_occurrence("PK", ["id"], star.PLACE, "repeated sale id"),
        R.references("FK", "producto_id", "productos", "id", "sale of an unlisted product"),
        R.out_of_range("CK", "cantidad", lambda c: c <= 2, "quantity not above two"),
    ]
    return quality.apply_rules(lines, constraints, LINES_AS_OF, refs={"productos": parts}).report


def fk_orphans(spark, sf):
    events, users = star.numbered(spark, sf, "events"), _solvent_users(spark, sf)
    orphans = joins.anti_join(events, users, "user_id", "c_custkey", spread_by=star.PLACE)
    return orphans.drop(*star.PLACE)


def fk_valid(spark, sf):
    events, users = star.numbered(spark, sf, "events"), _solvent_users(spark, sf)
    valid = joins.semi_join(events, users, "user_id", "c_custkey", spread_by=star.PLACE)
    return valid.drop(*star.PLACE)


def iqr_outliers(spark, sf):
    events = table(spark, sf, "events")
    limit = R.outlier_threshold(events, "value")
    judged = joins.cross_one_row(events, limit)
    return judged.where("value > threshold").select(
        "event_id", "value", F.round("threshold", 4).alias("threshold")
    )


def price_quartiles(spark, sf):
    lines = table(spark, sf, "lineitem")
    quartiles = ranking.exact_quantiles(
        lines, "l_extendedprice", {"q1": 0.25, "q2": 0.5, "q3": 0.75}, by=["l_returnflag"]
    )
    return quartiles.select("l_returnflag", *[F.round(q, 4).alias(q) for q in ("q1", "q2", "q3")])


def lenient_cast(spark, sf):
    """Text built from order lines, part of which is no number or no date."""
    lines = table(spark, sf, "lineitem").select(
        "l_returnflag",
        F.when(F.col("l_returnflag") == "R", F.concat(F.col("l_linenumber"), F.lit(" uds")))
        .otherwise(F.col("l_linenumber").cast("string"))
        .alias("number_text"),
        F.format_string(
            "%d-%02d-15 00:00:00", F.year("l_shipdate"), F.col("l_quantity").cast("int")
        ).alias("stamp_text"),
    )
    number, stamp = lenient_number(F.col("number_text")), lenient_timestamp(F.col("stamp_text"))
    return lines.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(number).alias("numbers"),
        F.sum(number).alias("number_sum"),
        F.count(stamp).alias("stamps"),
        F.min(stamp).alias("first_stamp"),
    )


# ---------------------------------------------------------------- sales reports
def sales_summary(spark, sf):
    return sales.resumen_general(star.line_sales(spark, sf))


def sales_by_part_type(spark, sf):
    return sales.ventas_por_categoria(star.line_sales(spark, sf), star.products(spark, sf))


def top5_products(spark, sf):
    return sales.top_productos(star.line_sales(spark, sf), star.products(spark, sf))


def monthly_trend(spark, sf):
    return sales.tendencia_mensual(star.line_sales(spark, sf))


def weekday_sales(spark, sf):
    return sales.ventas_por_dia_semana(star.line_sales(spark, sf))


def sales_by_region(spark, sf):
    return sales.ventas_por_region(star.order_sales(spark, sf))


def sales_by_channel(spark, sf):
    return sales.ventas_por_canal(star.order_sales(spark, sf))


def region_channel_pivot(spark, sf):
    return sales.region_por_canal(star.order_sales(spark, sf), star.PRIORITIES)


def daily_report(spark, sf):
    return sales.reporte_diario(star.placed_line_sales(spark, sf), star.products(spark, sf))


def sample_export(spark, sf):
    """The 500 earliest orders, written as CSV and read back."""
    orders = star.order_sales(spark, sf).select("id", "fecha", "region", "canal", "total")
    path = scratch_path(spark, "muestra")
    writers.export_sample(orders, ["fecha", "id"], path)
    back = spark.read.schema(all_text(orders.columns)).option("header", True).csv(path)
    return back.select(
        F.col("id").cast("bigint").alias("id"),
        F.col("fecha").cast("date").alias("fecha"),
        "region",
        "canal",
        F.col("total").cast("double").alias("total"),
    )


def joined_sample_export(spark, sf):
    """The 500 earliest sales with product and place, written as CSV and read back."""
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_linenumber").alias("linea"),
        F.col("l_partkey").alias("producto_id"),
        F.col("l_quantity").cast("int").alias("cantidad"),
        F.col("l_shipdate").cast("date").alias("fecha"),
        star.line_total().alias("total"),
    )
    sample = sales.muestra_con_lugar(lines, star.products(spark, sf), star.order_sales(spark, sf))
    path = scratch_path(spark, "muestra")
    writers.write_csv(sample.coalesce(1), path)
    back = spark.read.schema(all_text(sales.SAMPLE_FIELDS)).option("header", True).csv(path)
    kinds = {"id": "bigint", "cantidad": "int", "fecha": "date", "total": "double"}
    return back.select(*[F.col(c).cast(kinds.get(c, "string")).alias(c) for c in sales.SAMPLE_FIELDS])


def report_sections(spark, sf):
    """Sections of the text report with their number of lines."""
    fact, parts = star.line_sales(spark, sf), star.products(spark, sf)
    orders = star.order_sales(spark, sf)
    sections = [
        ("Resumen General", sales.resumen_general(fact)),
        ("Ingresos por Categoría", sales.ventas_por_categoria(fact, parts)),
        ("Ventas por Región", sales.ventas_por_region(orders)),
        ("Distribución por Canal", sales.ventas_por_canal(orders)),
        ("Top 5 Productos", sales.top_productos(fact, parts)),
        ("Tendencia Mensual", sales.tendencia_mensual(fact)),
        ("Ventas por Día de Semana", sales.ventas_por_dia_semana(fact)),
    ]
    path = scratch_path(spark, "reporte")
    writers.write_text_report(sections, path)
    lines = spark.read.text(path)
    head = F.split("value", r"\. | \| ", 3)
    return lines.groupBy(
        head[0].cast("int").alias("section_no"), head[1].alias("title")
    ).agg(F.count(F.lit(1)).alias("lines"))


def report_contents(spark, sf):
    """The whole text report, written and read back field by field."""
    sections = sales.full_report(
        star.placed_line_sales(spark, sf), star.products(spark, sf), star.PRIORITIES
    )
    path = scratch_path(spark, "reporte")
    writers.write_text_report(sections, path)
    return sales.report_entries(spark.read.text(path))


ALL_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def row_counts(spark, sf):
    counted = None
    for name in ALL_TABLES:
        one = spark.read.parquet(f"{sf}/{name}.parquet").agg(F.count(F.lit(1)).alias("row_count"))
        one = one.select(F.lit(name).alias("table_name"), "row_count")
        counted = one if counted is None else counted.unionByName(one)
    return counted


# ------------------------------------------------------------- sources and sinks
EVENT_TEXT = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _event_text(spark, sf):
    events = table(spark, sf, "events")
    stamp = stamp_text(F.col("ts"))
    return events.withColumn("ts", stamp).select(
        *[F.col(c).cast("string").alias(c) for c in EVENT_TEXT]
    )


def _feed_totals(feed):
    return feed.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("event_id").cast("bigint")).alias("id_sum"),
        money_sum(lenient_number(F.col("value"))).alias("total"),
        F.max(lenient_timestamp(F.col("ts"))).alias("last_ts"),
        F.sum(F.get_json_object("props", "$.k").cast("bigint")).alias("k_sum"),
    )


def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "feed-csv")
    writers.write_csv(_event_text(spark, sf), path)
    return _feed_totals(readers.read_source(spark, path, "csv", all_text(EVENT_TEXT)))


def jsonl_roundtrip(spark, sf):
    path = scratch_path(spark, "feed-jsonl")
    writers.write_jsonl(_event_text(spark, sf), path)
    return _feed_totals(readers.read_source(spark, path, "jsonl", all_text(EVENT_TEXT)))


def partitioned_roundtrip(spark, sf):
    """Orders by year and month, with the 1997 folders written a second time."""
    path = scratch_path(spark, "zone")
    orders = table(spark, sf, "orders").withColumns(
        {"year": F.year("o_orderdate"), "month": F.month("o_orderdate")}
    )
    writers.write_zone(orders, path, ["year", "month"])
    zone = writers.write_zone(
        orders.where("year = 1997").withColumn("o_totalprice", F.lit(1.0)), path, ["year", "month"]
    )
    return zone.groupBy("year").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("month").alias("months"),
        money_sum(F.col("o_totalprice")).alias("total"),
    )


def raw_archive(spark, sf):
    """Line archive of a text feed; header lines of the part files included."""
    path = scratch_path(spark, "raw")
    writers.write_jsonl(_event_text(spark, sf), path)
    archived = writers.archive_raw(spark, path, scratch_path(spark, "raw-lines"))
    return archived.agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.get_json_object("value", "$.event_id").cast("bigint")).alias("id_sum"),
    )


def idempotent_load(spark, sf):
    """Open orders, then all orders, then all again: every order once."""
    path = scratch_path(spark, "load")
    orders = table(spark, sf, "orders")
    writers.append_new(orders.where("o_orderstatus = 'O'"), path, "o_orderkey")
    writers.append_new(orders, path, "o_orderkey")
    stored = writers.append_new(orders, path, "o_orderkey")
    return stored.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("o_orderkey").alias("keys")
    )


def surrogate_keys(spark, sf):
    """Ids for the distinct part names, resolved back onto the parts."""
    parts = table(spark, sf, "part").select("p_partkey", "p_name")
    names = writers.assign_keys(parts.select("p_name").distinct(), "p_name", "name_id")
    return writers.resolve_keys(parts, names, "p_name", "name_id")


# ------------------------------------------------------------ lineage and catalog
def lineage_summary(spark, sf):
    """Two logged steps over the events: all to valid users, valid to clean."""
    log_path = scratch_path(spark, "linaje")
    root = scratch_path(spark, "pasos")
    events = table(spark, sf, "events")
    valid = writers.write_zone(fk_valid(spark, sf), f"{root}/valid")
    bought = writers.write_zone(valid.where("event_type = 'purchase'"), f"{root}/bought")
    rows = [events.count(), valid.count(), bought.count()]
    for name, before, after, target in (
        ("integridad_referencial", rows[0], rows[1], "valid"),
        ("filtro_compras", rows[1], rows[2], "bought"),
    ):
        governance.log_lineage(
            spark,
            log_path,
            {
                "origin": "events", "step": name, "target": f"{root}/{target}",
                "script": "table_queries.py", "rows_in": before, "rows_out": after,
            },
        )
    return governance.lineage_summary(readers.read_lineage(spark, log_path))


CATALOG_KEYS = {
    "region": (["r_regionkey", "r_name"], "r_regionkey"),
    "nation": (["n_nationkey", "n_name", "n_regionkey"], "n_nationkey"),
    "customer": (["c_custkey", "c_nationkey"], "c_custkey"),
    "supplier": (["s_suppkey", "s_nationkey"], "s_suppkey"),
    "part": (["p_partkey", "p_retailprice"], "p_partkey"),
    "orders": (["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"], "o_orderkey"),
    "lineitem": (["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"], None),
    "events": (["event_id", "user_id", "event_type", "ts"], "event_id"),
    "documents": (["doc_id"], "doc_id"),
    "embeddings": (["vec_id"], "vec_id"),
    "pages": (["page_id"], "page_id"),
    "benchmark": (["item_id"], "item_id"),
    "labels": (["doc_id"], "doc_id"),
    "conversations": (["conv_id", "turn"], None),
}


def lineage_skipped(spark, sf):
    """A log with one record per event, every seventh line cut off and every
    eleventh blank: steps and rows per transformation, and the lines skipped."""
    record = F.to_json(
        F.struct(
            F.col("event_type").alias("transformacion"),
            F.col("event_id").alias("filas_entrada"),
            F.col("user_id").alias("filas_salida"),
            F.greatest(F.col("event_id") - F.col("user_id"), F.lit(0)).alias("filas_eliminadas"),
        )
    )
    number = F.col("event_id")
    line = F.when(number % 11 == 0, F.lit("  ")).when(number % 7 == 0, F.substring(record, 1, 25)).otherwise(record)
    path = scratch_path(spark, "linaje-roto")
    table(spark, sf, "events").select(line.alias("value")).write.text(path)
    lines = readers.lineage_lines(spark, path)
    name = F.when(F.col("omitida"), F.lit("(omitidas)")).otherwise(F.col("transformacion"))
    return governance.lineage_summary(lines.withColumn("transformacion", name))


def field_catalog(spark, sf):
    """Every column of every given table; columns that name a row or belong to
    its key are required."""
    catalog = None
    for name in ALL_TABLES:
        fields, key = CATALOG_KEYS[name]
        part = governance.observed_fields(spark.read.parquet(f"{sf}/{name}.parquet"), name, fields, key)
        catalog = part if catalog is None else catalog.unionByName(part)
    return catalog


def nested_catalog(spark, sf):
    """The catalog of all given tables as one nested JSON document, written and
    read back to one row per column."""
    document = governance.observed_document(field_catalog(spark, sf))
    path = scratch_path(spark, "catalogo")
    writers.write_jsonl(document, path)
    return readers.read_nested(spark, path, document.schema, "tablas", "campos")


def rule_catalog(spark, sf):
    """The rules that judge the events, under their catalog names, with the
    violations found; a rule the catalog does not know by id is named by its kind."""
    found = dq_report_events(spark, sf).select(F.col("rule").alias("id"), "action", "violations")
    named = [(r.id, RULE_NAMES[r.kind]) for r in star_event_rules()]
    names = local_table(spark, named, "id string, nombre string")
    return found.join(F.broadcast(names), "id", "left").select(
        "id", F.coalesce("nombre", "id").alias("nombre"), F.col("action").alias("accion"), "violations"
    )


# ------------------------------------------------------------ scoring and scaling
CRITERIA_WEIGHTS = {"ingresos": 40.0, "unidades": 25.0, "lineas": 20.0, "descuento": 15.0}
WEIGHT_SHIFTS = {
    "base": {},
    "descuento+20": {"descuento": 20.0},
    "descuento-10": {"descuento": -10.0},
}


def _stacked_criteria(totals, alternative):
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("criterion"), F.col(column).alias("value"))
            for name, column in (
                ("ingresos", "_revenue"), ("unidades", "_units"), ("lineas", "_lines"),
                ("descuento", "_off"),
            )
        ]
    )
    return totals.select(F.col(alternative).alias("alternative"), F.explode(pairs).alias("_c")).select(
        "alternative", "_c.criterion", "_c.value"
    )


def _supplier_totals(spark, sf):
    """Per supplier: revenue, units, lines, and total discount, less being better."""
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        decimal_total(F.col("l_extendedprice"), MONEY_DIGITS).alias("_revenue"),
        decimal_total(F.col("l_quantity"), MONEY_DIGITS).alias("_units"),
        F.count(F.lit(1)).cast("decimal(28,6)").alias("_lines"),
        (-decimal_total(F.col("l_discount"), MONEY_DIGITS)).alias("_off"),
    )


def _scored(criteria):
    scored = ranking.quintiles_by_measure(criteria, "criterion", ["value", "alternative"], "score")
    return scored.select("alternative", "criterion", "score")


def _supplier_scores(spark, sf):
    return _scored(_stacked_criteria(_supplier_totals(spark, sf), "l_suppkey"))


def mcda_scores(spark, sf):
    weights = scoring.weight_table(spark, CRITERIA_WEIGHTS)
    return scoring.rank_scores(scoring.weighted_scores(_supplier_scores(spark, sf), weights))


def mcda_sensitivity(spark, sf):
    scenarios = scoring.scenario_table(spark, CRITERIA_WEIGHTS, WEIGHT_SHIFTS)
    return scoring.sensitivity(_supplier_scores(spark, sf), scenarios)


def mcda_matrix(spark, sf):
    """Regions as alternatives."""
    suppliers = table(spark, sf, "supplier").join(
        F.broadcast(star.places(spark, sf)), F.col("s_nationkey") == F.col("n_nationkey")
    )
    totals = (
        _supplier_totals(spark, sf)
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("r_name")
        .agg(*[F.sum(c).alias(c) for c in ("_revenue", "_units", "_lines", "_off")])
    )
    scores = _scored(_stacked_criteria(totals, "r_name"))
    weights = scoring.weight_table(spark, CRITERIA_WEIGHTS)
    return scoring.score_matrix(scores, weights, star.REGIONS)


def math_kernel(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_linenumber", trig_kernel(F.col("l_quantity")).alias("_k")
    )
    return lines.groupBy("l_linenumber").agg(
        F.round(F.sum("_k"), 6).alias("kernel_sum"),
        F.count(F.lit(1)).alias("n"),
    )


def _run_log(spark, sf):
    """Order lines read as measured runs: the line number is the worker count."""
    serial = F.lit(0.05)
    return table(spark, sf, "lineitem").select(
        F.concat("l_returnflag", "l_linestatus").alias("job"),
        F.col("l_linenumber").alias("p"),
        (F.col("l_extendedprice") * (serial + (F.lit(1.0) - serial) / F.col("l_linenumber"))).alias(
            "seconds"
        ),
    )


def scaling_report(spark, sf):
    report = scaling.scaling_report(_run_log(spark, sf))
    return report.select(
        "job", "p", *[F.round(c, 6).alias(c) for c in ("median_seconds", "speedup", "efficiency")]
    )


def amdahl_fit(spark, sf):
    fit = scaling.scaling_verdict(scaling.amdahl_fit(_run_log(spark, sf)), 8)
    rounded = ("start_fraction", "serial_fraction", "r2", "max_speedup", "predicted_speedup")
    return fit.select("job", "points", "verdict", *[F.round(c, 5).alias(c) for c in rounded])


# ----------------------------------------------------------------- medallion run
def _star_feeds(spark, sf, root):
    """Orders and events as raw text feeds."""
    orders = table(spark, sf, "orders")
    txn = orders.select(
        labelled_id("TXN-", F.col("o_orderkey"), 6).alias("transaction_id"),
        labelled_id("USR-", F.col("o_custkey"), 4).alias("user_id"),
        F.concat(F.lit("PRD-"), F.col("o_orderpriority")).alias("product_id"),
        F.col("o_orderpriority").alias("category"),
        F.col("o_totalprice").alias("amount"),
        F.lit(1).alias("quantity"),
        stamp_text(F.col("o_orderdate")).alias("date"),
        F.col("o_orderstatus").alias("payment_method"),
        F.col("o_orderstatus").alias("status"),
        F.lit("CL").alias("country"),
    )
    events = table(spark, sf, "events")
    evt = events.select(
        labelled_id("EVT-", F.col("event_id"), 7).alias("event_id"),
        labelled_id("USR-", F.col("user_id"), 4).alias("user_id"),
        star.session_key().alias("session_id"),
        "event_type",
        F.col("props").alias("page"),
        stamp_text(F.col("ts")).alias("timestamp"),
        F.lit("mobile").alias("device"),
        F.lit("Chrome").alias("browser"),
        F.col("value").alias("duration_sec"),
    )
    paths = f"{root}/seeds/transacciones.csv", f"{root}/seeds/eventos.jsonl"
    together(
        lambda: writers.write_csv(txn.select(*TRANSACTION_FEED.fieldNames()), paths[0]),
        lambda: writers.write_jsonl(evt, paths[1]),
    )
    return paths


def _star_feed_rules():
    """The standard rule sets with the vocabularies and id widths of the star."""
    txn = {r.id: r for r in transaction_rules(r"^TXN-[0-9]{6,}$")}
    txn["R04a"] = R.allowed("R04a", "category", star.PRIORITIES[:4], "unknown category")
    txn["R04b"] = R.allowed("R04b", "payment_method", ["F", "O"], "unknown payment_method")
    evt = {r.id: r for r in event_rules(r"^EVT-[0-9]{7,}$")}
    evt["R04a"] = R.allowed("R04a", "event_type", star.STEPS, "unknown event_type")
    evt["R05"] = R.not_future("R05", "timestamp", "after the reference instant")
    return list(txn.values()), list(evt.values())


def medallion_zone_rows(spark, sf, as_of=EVENTS_AS_OF):
    """Full run over feeds derived from orders and events: rows per zone table."""
    root = scratch_path(spark, "medallion")
    txn_path, evt_path = _star_feeds(spark, sf, root)
    txn_rules, evt_rules = _star_feed_rules()
    run = run_pipeline(
        spark,
        PipelineConfig(
            root=root, as_of=as_of, transactions_path=txn_path, events_path=evt_path,
            transaction_rules=txn_rules, event_rules=evt_rules,
            categories=star.PRIORITIES, funnel_steps=star.STEPS,
        ),
    )
    zones = {"bronze": run.bronze, "silver": run.silver, "gold": run.gold}
    counted = None
    for zone, frames in zones.items():
        for name, frame in frames.items():
            one = frame.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(zone).alias("zone"), F.lit(name).alias("table_name"), "row_count"
            )
            counted = one if counted is None else counted.unionByName(one)
    return counted


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        sales_by_category_month, top_categories, country_category_pivot, monthly_running_total,
        monthly_chart, country_share, user_profile, conversion_funnel, behaviour_by_device,
        rfm_scores, rfm_segments, segment_counts, order_price_rank, supplier_balance_quintile,
        dq_report_events, dq_clean_events, dq_stats, tiny_sums, dq_report_lineitem, dq_clean_lineitem, dedup_lineitem_first,
        constraint_report, fk_orphans, fk_valid, iqr_outliers, price_quartiles, lenient_cast,
        sales_summary, sales_by_part_type, top5_products, monthly_trend, weekday_sales,
        sales_by_region, sales_by_channel, region_channel_pivot, daily_report, sample_export, joined_sample_export,
        report_sections, report_contents, row_counts, csv_roundtrip, jsonl_roundtrip, partitioned_roundtrip,
        raw_archive, idempotent_load, surrogate_keys, lineage_summary, lineage_skipped, field_catalog,
        nested_catalog, quality_document, rule_catalog, mcda_scores, mcda_sensitivity, mcda_matrix, math_kernel, scaling_report,
        amdahl_fit, medallion_zone_rows, stamp_layouts, faulty_event_report, faulty_event_rows,
        faulty_star_report,
    )
}
