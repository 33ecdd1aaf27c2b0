"""Zone, report, lineage and export sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercadal.functions.scalars import utc_now_text
from mercadal.operators.joins import lookup_join
from mercadal.operators.ranking import distributed_row_number


def write_zone(df: DataFrame, path: str, partition_cols: Sequence[str] | None = None) -> DataFrame:
    """Parquet zone write, returned as a scan of what was written.

    Only the partitions present in ``df`` are replaced. Rows are rebalanced on
    the partition columns first: few files per folder, while a folder holding
    most rows is still split over many tasks. Row counts come from the footers
    of the result rather than from metrics of the write, which may count a
    re-run task twice.
    """
    spark = df.sparkSession
    if partition_cols:
        balanced = df.hint("rebalance", *[F.col(c) for c in partition_cols])
        (
            balanced.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partition_cols)
            .parquet(path)
        )
    else:
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def archive_raw(spark: SparkSession, source: str, path: str) -> DataFrame:
    """Line-level copy of a raw text source with the place of every line."""
    lines = spark.read.text(source).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block_start"),
        F.monotonically_increasing_id().alias("_row_id"),
    )
    return write_zone(lines, path)


def write_query_results(frames: Mapping[str, object], folder: str) -> list[str]:
    """One Parquet table per frame; anything that is not a frame is skipped."""
    written = []
    for name, df in frames.items():
        if isinstance(df, DataFrame):
            path = f"{folder}/query_{name}.parquet"
            df.write.mode("overwrite").parquet(path)
            written.append(path)
    return written


def write_quality_report(
    reports: Mapping[str, DataFrame], stats: Mapping[str, DataFrame], folder: str
) -> DataFrame:
    """Long rule table as Parquet, one nested JSON document per data set and one of all.

    Returns the long table. A report has one row per rule, so the nested
    arrays stay small.
    """
    long = None
    for name, report in reports.items():
        part = report.select(F.lit(name).alias("dataset"), "*")
        long = part if long is None else long.unionByName(part)
    stored = write_zone(long.coalesce(1), f"{folder}/reglas.parquet")
    for name, frame in stats.items():
        rules = stored.where(F.col("dataset") == name).agg(
            F.sort_array(
                F.collect_list(F.struct("rule", "description", "violations", "pct", "action"))
            ).alias("reglas")
        )
        document = (
            frame.coalesce(1)
            .select(F.struct("*").alias("estadisticas"))
            .join(F.broadcast(rules), how="cross")
            .withColumn("generado_utc", utc_now_text())
        )
        document.write.mode("overwrite").json(f"{folder}/reporte_calidad/{name}")
    kept = {name: stored.where(F.col("dataset") == name) for name in stats}
    write_jsonl(quality_document(kept, stats).coalesce(1), f"{folder}/reporte_calidad_completo")
    return stored


REPORT_FIELDS = ("rule", "description", "violations", "pct", "action")


def quality_document(
    reports: Mapping[str, DataFrame], stats: Mapping[str, DataFrame]
) -> DataFrame:
    """One nested row for all data sets: each with its statistics and its rules,
    in the order given. A report has one row per rule, so the arrays stay small."""
    parts = None
    for at, (name, report) in enumerate(reports.items()):
        rules = report.agg(F.sort_array(F.collect_list(F.struct(*REPORT_FIELDS))).alias("reglas"))
        figures = stats[name].select(F.struct("*").alias("estadisticas"))
        part = figures.join(F.broadcast(rules), how="cross").select(
            F.struct(F.lit(at).alias("_at"), F.lit(name).alias("dataset"), "estadisticas", "reglas").alias("_part")
        )
        parts = part if parts is None else parts.unionByName(part)
    whole = parts.agg(F.sort_array(F.collect_list("_part")).alias("_parts"))
    return whole.select(
        F.transform("_parts", lambda p: p.dropFields("_at")).alias("conjuntos"), utc_now_text().alias("generado_utc")
    )


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header; nulls and empty strings are both empty fields."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').option(
        "emptyValue", ""
    ).csv(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines that keep keys with null values."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def export_sample(df: DataFrame, order: Sequence[str], path: str, rows: int = 500) -> None:
    """First ``rows`` rows under ``order`` as a single CSV file."""
    write_csv(df.orderBy(*order).limit(rows).coalesce(1), path)


def write_text_report(sections: Sequence[tuple[str, DataFrame]], path: str) -> DataFrame:
    """Numbered sections of row documents, one line each; returns the lines.

    Sections are report results (aggregates), each row as one JSON text.
    """
    lines = None
    for number, (title, df) in enumerate(sections, start=1):
        part = df.select(
            F.lit(number).alias("section_no"),
            F.lit(title).alias("title"),
            F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row_json"),
        )
        lines = part if lines is None else lines.unionByName(part)
    text = F.format_string("%d. %s | %s", "section_no", "title", "row_json")
    lines.select(text.alias("value")).write.mode("overwrite").text(path)
    return lines


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
               batch_size: int = 10_000) -> None:
    """Batched multi-row append to a relational table."""
    df.write.format("jdbc").mode("append").option("url", url).option("dbtable", table).option(
        "batchsize", batch_size
    ).options(**(properties or {})).save()


def _loaded(df: DataFrame, path: str) -> DataFrame | None:
    """What is stored at ``path`` with the columns of ``df``; None without a row."""
    try:
        present = df.sparkSession.read.schema(df.schema).parquet(path)
    except Exception as problem:
        if getattr(problem, "getCondition", lambda: None)() != "PATH_NOT_FOUND":
            raise
        return None
    return None if present.isEmpty() else present


def append_new(df: DataFrame, path: str, key: str) -> DataFrame:
    """Idempotent load: appends one row for each key that is not stored yet;
    which one, of rows that share a new key, is left open."""
    batch = df.dropDuplicates([key])
    present = _loaded(df, path)
    if present is not None:
        known = present.select(key).distinct().withColumn("_stored", F.lit(True))
        batch = lookup_join(batch, known, [key], ["_stored"]).where(F.col("_stored").isNull())
        batch = batch.drop("_stored")
    batch.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def load_once(df: DataFrame, path: str) -> DataFrame:
    """Skips the load when the target holds rows already."""
    if _loaded(df, path) is None:
        df.write.mode("append").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def assign_keys(dimension: DataFrame, natural_key: str, out: str = "id") -> DataFrame:
    """Surrogate keys 1..n in the order of a unique natural key."""
    return distributed_row_number(dimension, [natural_key], out)


def resolve_keys(fact: DataFrame, dimension: DataFrame, natural_key: str, key: str) -> DataFrame:
    """Replaces nothing, adds the surrogate ``key`` found by ``natural_key``."""
    return lookup_join(fact, dimension, [natural_key], [key])
