"""Lineage log and catalog."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercadal.functions.scalars import base_name, utc_now_text, whole_seconds
from mercadal.schemas import CATALOG_VERSION, GOLD, LINEAGE, RULE_NAMES, feeds
from mercadal.session import local_table

FIELD_SCHEMA = (
    "dataset string, campo string, tipo string, descripcion string, fuente string, "
    "obligatorio boolean, clave_primaria boolean, patron string, rango string, "
    "valores_permitidos array<string>, reglas array<string>"
)


def lineage_records(spark: SparkSession, records: Sequence[Mapping]) -> DataFrame:
    """A row per step; rows dropped never go below zero."""
    facts = local_table(
        spark,
        [
            (
                r["origin"], r["step"], r["target"], r["script"], r.get("rows_in", 0),
                r.get("rows_out", 0), r.get("notes", ""), r.get("seconds"),
            )
            for r in records
        ],
        "origen string, transformacion string, destino string, script_responsable string, "
        "filas_entrada long, filas_salida long, notas string, segundos double",
    )
    dropped = F.greatest(F.lit(0), F.col("filas_entrada") - F.col("filas_salida"))
    return facts.withColumns(
        {"timestamp_utc": utc_now_text(), "filas_eliminadas": dropped.cast("long")}
    ).select(*LINEAGE.fieldNames())


def log_lineage(spark: SparkSession, path: str, *records: Mapping) -> None:
    """Appends the records of one or more steps to the JSON-lines log."""
    lineage_records(spark, records).coalesce(1).write.mode("append").json(path)


def lineage_table(log: DataFrame) -> DataFrame:
    """The eight display fields: stamps to the second, paths to their last part."""
    return log.select(
        whole_seconds(F.col("timestamp_utc")).alias("timestamp_utc"),
        base_name(F.col("origen")).alias("origen"),
        "transformacion",
        base_name(F.col("destino")).alias("destino"),
        base_name(F.col("script_responsable")).alias("script_responsable"),
        "filas_entrada", "filas_salida", "filas_eliminadas",
    )


def lineage_summary(log: DataFrame) -> DataFrame:
    """Steps and rows in, out and dropped per transformation."""
    return log.groupBy("transformacion").agg(
        F.count(F.lit(1)).alias("pasos"),
        F.sum("filas_entrada").alias("filas_entrada"),
        F.sum("filas_salida").alias("filas_salida"),
        F.sum("filas_eliminadas").alias("filas_eliminadas"),
    )


def field_catalog(spark: SparkSession) -> DataFrame:
    """One row per feed column, described by what the rules ask of it."""
    rows = []
    for feed in feeds():
        for column in feed.columns:
            own = feed.rules_of(column)
            kinds = {r.kind for r in own}
            rows.append(
                (
                    feed.name, column, feed.types.get(column, "string"),
                    "; ".join(r.description for r in own) or None, feed.name,
                    "required" in kinds, "key" in kinds,
                    next((r.pattern for r in own if r.pattern), None),
                    next((r.description for r in own if r.kind == "range"), None),
                    next((list(r.allowed) for r in own if r.allowed), None),
                    [r.id for r in own],
                )
            )
    return local_table(spark, rows, FIELD_SCHEMA)


def rule_catalog(spark: SparkSession) -> DataFrame:
    """One row per rule id in force; what feeds check under one id is listed together."""
    found: dict[str, tuple[str, str, list[str]]] = {}
    for feed in feeds():
        for rule in feed.rules:
            entry = found.setdefault(rule.id, (RULE_NAMES[rule.kind], rule.action, []))
            entry[2].append(f"{feed.name}: {rule.description}")
    rows = [(i, name, "; ".join(what), action) for i, (name, action, what) in sorted(found.items())]
    return local_table(spark, rows, "id string, nombre string, descripcion string, accion string")


def catalog_document(spark: SparkSession) -> DataFrame:
    """The whole catalog as one nested row."""
    fields = field_catalog(spark)
    members = [c for c in fields.columns if c != "dataset"]
    per_source = fields.groupBy("dataset").agg(
        F.collect_list(F.struct(*members)).alias("campos")  # fields of one feed
    )
    heads = local_table(
        spark,
        [
            (i, f.name, f.format, f"bronze/{f.name}", f"silver/{f.name}")
            for i, f in enumerate(feeds())
        ],
        "_at int, nombre string, formato_origen string, zona_bronze string, zona_silver string",
    )
    sources = heads.join(per_source, heads["nombre"] == per_source["dataset"]).drop("dataset")
    source_list = sources.agg(
        F.sort_array(
            F.collect_list(
                F.struct("_at", "nombre", "formato_origen", "zona_bronze", "zona_silver", "campos")
            )
        ).alias("fuentes")
    )
    gold = local_table(
        spark,
        [
            (g.name, f"gold/{g.name}", list(g.partitioned_by), [f"silver/{f}" for f in g.feeds])
            for g in GOLD
        ],
        "nombre string, ruta string, particionado_por array<string>, origen array<string>",
    )
    gold_list = gold.agg(F.collect_list(F.struct("*")).alias("tablas_gold"))
    rules = rule_catalog(spark).agg(
        F.sort_array(F.collect_list(F.struct("*"))).alias("reglas_calidad")
    )
    bare = F.transform("fuentes", lambda s: s.dropFields("_at")).alias("fuentes")
    return (
        source_list.join(F.broadcast(gold_list), how="cross")
        .join(F.broadcast(rules), how="cross")
        .select(
            F.lit(CATALOG_VERSION).alias("version"), bare, "tablas_gold", "reglas_calidad",
            utc_now_text().alias("generado_utc"),
        )
    )


def write_catalog(spark: SparkSession, path: str) -> None:
    catalog_document(spark).coalesce(1).write.mode("overwrite").json(path)


def observed_fields(df: DataFrame, dataset: str, required: list[str], key: str) -> DataFrame:
    """Catalog rows of a stored table with what its data shows: one row per
    column with type, required and key marks, rows and nulls. One scan."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in df.columns],
    )
    entries = [
        F.struct(
            F.lit(f.name).alias("campo"),
            F.lit(f.dataType.simpleString()).alias("tipo"),
            F.lit(f.name in required).alias("obligatorio"),
            F.lit(f.name == key).alias("clave_primaria"),
            F.col(f"_null_{f.name}").alias("nulos"),
        )
        for f in df.schema.fields
    ]
    return counts.select("_rows", F.explode(F.array(*entries)).alias("_f")).select(
        F.lit(dataset).alias("dataset"), "_f.*", F.col("_rows").alias("filas")
    )


def observed_document(observed: DataFrame) -> DataFrame:
    """One nested row of all stored tables: each with its rows and its fields.
    ``observed`` has one row per column of a table (``observed_fields``)."""
    members = [c for c in observed.columns if c not in ("dataset", "filas")]
    per_table = observed.groupBy("dataset", "filas").agg(
        F.sort_array(F.collect_list(F.struct(*members))).alias("campos")
    )
    tables = per_table.agg(F.sort_array(F.collect_list(F.struct("dataset", "filas", "campos"))).alias("tablas"))
    return tables.select(F.lit(CATALOG_VERSION).alias("version"), "tablas", utc_now_text().alias("generado_utc"))
