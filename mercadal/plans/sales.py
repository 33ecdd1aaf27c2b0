"""Reports over the sales star: fact ``ventas`` and dimension ``productos``.

Reports on product attributes alone join the products after the fact has been
reduced to one row per product, on the same partitioning: the fact is shuffled
once, as partial sums, and a product holding a large share of the sales
collapses before that shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercadal.functions.exact import finite
from mercadal.functions.scalars import MONEY_DIGITS, decimal_total, half_up, money_mean, month_key, weekday_name, weekday_number
from mercadal.operators.aggregates import pivot_sum, share_of_total, top_k
from mercadal.session import materialize


def _revenue(digits: int):
    return F.round(decimal_total(F.col("total"), MONEY_DIGITS), digits).cast("double")


def _ticket(digits: int):
    return half_up(money_mean(F.col("total")), digits)


def resumen_general(sales: DataFrame) -> DataFrame:
    return sales.agg(
        F.count(F.lit(1)).alias("total_transacciones"),
        F.sum("cantidad").alias("unidades_totales"),
        _revenue(0).alias("ingresos_totales"),
        _ticket(0).alias("ticket_promedio"),
        F.min("fecha").alias("primera_venta"),
        F.max("fecha").alias("ultima_venta"),
    )


def _per_product(sales: DataFrame) -> DataFrame:
    return sales.groupBy("producto_id").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("cantidad").alias("_u"),
        decimal_total(F.col("total"), MONEY_DIGITS).alias("_t"),
    )


def _by_product_attributes(sales: DataFrame, products: DataFrame, keys: Sequence[str]):
    named = products.select(F.col("id").alias("producto_id"), *keys)
    return (
        _per_product(sales)
        .join(named, "producto_id")
        .groupBy(*keys)
        .agg(
            F.sum("_n").alias("num_ventas"),
            F.sum("_u").alias("unidades"),
            F.sum("_t").alias("_total"),
        )
    )


def ventas_por_categoria(sales: DataFrame, products: DataFrame) -> DataFrame:
    groups = _by_product_attributes(sales, products, ["categoria"])
    shared = share_of_total(groups, "_total", "pct_ingresos", 1)
    return shared.select(
        "categoria", "num_ventas", "unidades",
        F.round("_total", 0).cast("double").alias("ingresos"), "pct_ingresos",
    ).orderBy(F.desc("ingresos"), "categoria")


def top_productos(sales: DataFrame, products: DataFrame, k: int = 5) -> DataFrame:
    groups = _by_product_attributes(sales, products, ["nombre", "categoria"])
    named = groups.select(
        "nombre", "categoria", "num_ventas", "unidades",
        F.round("_total", 0).cast("double").alias("ingresos"),
    )
    return top_k(named, [F.desc("ingresos"), F.asc("nombre"), F.asc("categoria")], k)


def ventas_por_region(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("region")
        .agg(
            F.count(F.lit(1)).alias("num_ventas"),
            _revenue(0).alias("ingresos"),
            _ticket(0).alias("ticket_promedio"),
        )
        .orderBy(F.desc("ingresos"), "region")
    )


def ventas_por_canal(sales: DataFrame) -> DataFrame:
    groups = sales.groupBy("canal").agg(
        F.count(F.lit(1)).alias("num_ventas"), _revenue(0).alias("ingresos")
    )
    return share_of_total(groups, "num_ventas", "pct_ventas", 1).orderBy(
        F.desc("ingresos"), "canal"
    )


def tendencia_mensual(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy(month_key(F.col("fecha")).alias("mes"))
        .agg(F.count(F.lit(1)).alias("num_ventas"), _revenue(0).alias("ingresos"))
        .orderBy("mes")
    )


def ventas_por_dia_semana(sales: DataFrame) -> DataFrame:
    """Grouped by day number; the padded name follows from it."""
    day = F.col("fecha")
    return (
        sales.groupBy(weekday_number(day).alias("dow"), weekday_name(day).alias("dia_semana"))
        .agg(F.count(F.lit(1)).alias("num_ventas"), _ticket(0).alias("ticket_promedio"))
        .select("dia_semana", "dow", "num_ventas", "ticket_promedio")
        .orderBy("dow")
    )


def reporte_diario(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Day x category x region x channel.

    Joined before any grouping: within a day, region and channel a product
    seldom sells twice, so there is nothing to gain from reducing the fact
    first. A product with very many sales is split by the adaptive skew join.
    """
    named = products.select(F.col("id").alias("producto_id"), "categoria")
    return (
        sales.join(named, "producto_id")
        .groupBy("fecha", "categoria", "region", "canal")
        .agg(
            F.count(F.lit(1)).alias("num_ventas"),
            F.sum("cantidad").alias("unidades_vendidas"),
            _revenue(2).alias("ingresos_totales"),
            _ticket(2).alias("ticket_promedio"),
        )
    )


def register_daily_view(sales: DataFrame, products: DataFrame, name: str = "reporte_diario"):
    reporte_diario(sales, products).createOrReplaceTempView(name)


def region_por_canal(sales: DataFrame, channels: Sequence[str]) -> DataFrame:
    """Region x channel revenue with a TOTAL column, empty cells 0."""
    cells = sales.groupBy("region", "canal").agg(
        F.round(decimal_total(F.col("total"), MONEY_DIGITS), 0).alias("ingresos")
    )
    table = pivot_sum(cells, "region", "canal", channels, "ingresos", total="TOTAL")
    rest = [c for c in table.columns if c != "region"]
    return table.select("region", *[F.col(f"`{c}`").cast("double").alias(c) for c in rest])


def muestra(sales: DataFrame, products: DataFrame, rows: int = 500) -> DataFrame:
    """The earliest ``rows`` sales with their product, ties by id.

    The sample is taken before the join: only its rows meet the dimension, and
    they are few enough to broadcast.
    """
    first = sales.orderBy("fecha", "id").limit(rows)
    named = products.select(F.col("id").alias("producto_id"), "nombre", "categoria")
    joined = named.join(F.broadcast(first), "producto_id")
    return joined.select(
        "id", "nombre", "categoria", "cantidad", "fecha", "region", "canal", "total"
    ).orderBy("fecha", "id")


# Titles of the text report, fixed values.
REPORT_TITLES = (
    "Resumen General", "Ingresos por Categoría", "Ventas por Región", "Distribución por Canal",
    "Top 5 Productos", "Tendencia Mensual", "Ventas por Día de Semana", "Región × Canal",
)
# what tells the rows of a section apart
REPORT_KEYS = (
    (), ("categoria",), ("region",), ("canal",), ("nombre", "categoria"), ("mes",), ("dia_semana",), ("region",),
)


def _partials():
    total = F.col("total")
    return (
        F.count(F.lit(1)).alias("_n"),
        F.count(finite(total)).alias("_m"),
        decimal_total(total, MONEY_DIGITS).alias("_t"),
    )


def report_cells(sales: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Partial sums per product and day and per region and channel, each stored
    once: rows, rows with an amount, exact amounts and units. Every section of
    the report is a sum of these, so the fact is read twice for all of them."""
    days = sales.groupBy("producto_id", "fecha").agg(*_partials(), F.sum("cantidad").alias("_u"))
    places = sales.groupBy("region", "canal").agg(*_partials())
    return materialize(days, "ventas_dia"), materialize(places, "ventas_lugar")


def _count(name: str):
    return F.coalesce(F.sum("_n"), F.lit(0)).alias(name)


def _sum(name: str = "ingresos"):
    return F.round(F.sum("_t"), 0).cast("double").alias(name)


def _mean():
    return half_up(F.sum("_t").cast("double") / F.nullif(F.sum("_m"), F.lit(0)), 0).alias("ticket_promedio")


def _summary_section(days: DataFrame) -> DataFrame:
    return days.agg(
        _count("total_transacciones"),
        F.sum("_u").alias("unidades_totales"),
        _sum("ingresos_totales"),
        _mean(),
        F.min("fecha").alias("primera_venta"),
        F.max("fecha").alias("ultima_venta"),
    )


def _product_sections(days: DataFrame, products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Categories and the five products of most revenue."""
    per_product = days.groupBy("producto_id").agg(*[F.sum(c).alias(c) for c in ("_n", "_u", "_t")])
    named = products.select(F.col("id").alias("producto_id"), "nombre", "categoria")
    sold = per_product.join(named, "producto_id")
    sums = (_count("num_ventas"), F.sum("_u").alias("unidades"), F.sum("_t").alias("_total"))
    revenue = F.round("_total", 0).cast("double").alias("ingresos")
    categories = share_of_total(sold.groupBy("categoria").agg(*sums), "_total", "pct_ingresos", 1)
    goods = sold.groupBy("nombre", "categoria").agg(*sums)
    return (
        categories.select("categoria", "num_ventas", "unidades", revenue, "pct_ingresos").orderBy(F.desc("ingresos"), "categoria"),
        top_k(
            goods.select("nombre", "categoria", "num_ventas", "unidades", revenue),
            [F.desc("ingresos"), F.asc("nombre"), F.asc("categoria")], 5,
        ),
    )


def full_report(
    sales: DataFrame, products: DataFrame, channels: Sequence[str]
) -> list[tuple[str, DataFrame]]:
    """Titled sections of the text report, over two stored aggregates."""
    days, places = report_cells(sales)
    categories, best = _product_sections(days, products)
    day = F.col("fecha")
    per_channel = places.groupBy("canal").agg(_count("num_ventas"), _sum())
    weekdays = days.groupBy(weekday_name(day).alias("dia_semana"), weekday_number(day).alias("dow"))
    rounded = places.select("region", "canal", F.round("_t", 0).alias("ingresos"))
    grid = pivot_sum(rounded, "region", "canal", channels, "ingresos", total="TOTAL")
    amounts = [F.col(f"`{c}`").cast("double").alias(c) for c in grid.columns if c != "region"]
    sections = (
        _summary_section(days),
        categories,
        places.groupBy("region").agg(_count("num_ventas"), _sum(), _mean()).orderBy(F.desc("ingresos"), "region"),
        share_of_total(per_channel, "num_ventas", "pct_ventas", 1).orderBy(F.desc("ingresos"), "canal"),
        best,
        days.groupBy(month_key(day).alias("mes")).agg(_count("num_ventas"), _sum()).orderBy("mes"),
        weekdays.agg(_count("num_ventas"), _mean()).orderBy("dow"),
        grid.select("region", *amounts),
    )
    return list(zip(REPORT_TITLES, sections, strict=True))


def report_entries(lines: DataFrame) -> DataFrame:
    """The written lines of a report as rows again: one per section, row and
    field, the value as a number where it is one and as text elsewhere."""
    head = F.split("value", r"\. | \| ", 3)
    number = head[0].cast("int")
    row = F.from_json(head[2], "map<string,string>")
    keys = F.get(F.array(*[F.array(*map(F.lit, k)).cast("array<string>") for k in REPORT_KEYS]), number - 1)
    parts = lines.select(number.alias("section_no"), head[1].alias("title"), keys.alias("_keys"), row.alias("_row")).select(
        "section_no", "title", "_keys",
        F.array_join(F.transform("_keys", lambda k: F.element_at("_row", k)), "/").alias("fila"),
        F.explode("_row").alias("campo", "_text"),
    )
    value = F.col("_text").try_cast("double")
    return parts.where(~F.array_contains("_keys", F.col("campo"))).select(
        "section_no", "title", "fila", "campo", F.when(value.isNull(), F.col("_text")).alias("texto"), value.alias("valor")
    )


SAMPLE_FIELDS = ["id", "nombre", "categoria", "cantidad", "fecha", "region", "canal", "total"]


def muestra_con_lugar(lines: DataFrame, products: DataFrame, places: DataFrame, rows: int = 500) -> DataFrame:
    """The earliest sales with their product and place, eight columns.

    The rows are chosen first, from narrow columns; products and places are then
    read past that handful, which is all that is broadcast (``rows`` of them).
    ``places`` has one row per sale id: id, region, canal.
    """
    order = ["fecha", "id", "linea", "producto_id", "cantidad", "total"]
    chosen = lines.select(*order).orderBy(*order).limit(rows)
    named = products.select(F.col("id").alias("producto_id"), "nombre", "categoria")
    with_names = named.join(F.broadcast(chosen), "producto_id")
    placed = places.select("id", "region", "canal").join(F.broadcast(with_names), "id")
    return placed.orderBy(*order).select(*SAMPLE_FIELDS)
