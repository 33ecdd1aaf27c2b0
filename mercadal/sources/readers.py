"""Bronze readers and scans."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from mercadal.functions.scalars import utc_now_text
from mercadal.schemas import LINEAGE
from mercadal.session import local_table


def _technical(df: DataFrame, columns: list[str]) -> DataFrame:
    """Business columns plus source file, ingest stamp and the row's place.

    (file, block start, id inside the scan) follows file order; the id alone
    would not, since splits are packed by size.
    """
    return df.select(
        *columns,
        F.col("_metadata.file_name").alias("_source_file"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block_start"),
        F.monotonically_increasing_id().alias("_row_id"),
    ).withColumn("_ingested_at", utc_now_text())


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    sep: str = ",",
    empty_as_null: bool = False,
    multiline: bool = False,
) -> DataFrame:
    """All-text CSV scan with header. Empty fields stay ``""`` by default.

    The header must agree with the schema. ``multiline`` allows line breaks in
    quoted fields but makes files unsplittable, so it is off.
    """
    raw = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    rows = _technical(raw, schema.fieldNames())
    return rows if empty_as_null else rows.na.fill("", subset=schema.fieldNames())


def read_jsonl(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All-text JSON-lines scan: blank lines skipped, a malformed line fails
    the read, the text ``None`` and missing keys are null."""
    raw = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    rows = _technical(raw, schema.fieldNames())
    return rows.withColumns(
        {c: F.nullif(F.col(c), F.lit("None")) for c in schema.fieldNames()}
    )


def read_source(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: StructType,
    sep: str = ",",
    empty_as_null: bool = False,
) -> DataFrame:
    """Reader by format name."""
    if fmt == "csv":
        return read_csv(spark, path, schema, sep, empty_as_null)
    if fmt == "jsonl":
        return read_jsonl(spark, path, schema)
    raise ValueError(f"unknown format: {fmt}")


def read_zone(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan; year=/month= folders become columns and prune."""
    return spark.read.parquet(path)


def lineage_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line of the log that is not blank: its text (``linea``), file, the
    fields of the record, and whether it was skipped because it is no record
    (``omitida``; the fields are null then). An absent log has no lines."""
    read = StructType([*LINEAGE.fields, StructField("_corrupt", StringType())])
    try:
        lines = spark.read.text(path).select(F.col("value").alias("linea"), F.col("_metadata.file_path").alias("archivo"))
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        lines = local_table(spark, [], "linea string, archivo string")
    lines = lines.where(F.trim("linea", F.lit(" \t\r")) != "")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = lines.withColumn("_r", F.from_json("linea", read, options))
    skipped = F.col("_r").isNull() | F.col("_r._corrupt").isNotNull()
    columns = [F.when(~F.col("omitida"), F.col(f"_r.{name}")).alias(name) for name in LINEAGE.fieldNames()]
    return parsed.withColumn("omitida", skipped).select("linea", "archivo", *columns, "omitida")


def read_lineage(spark: SparkSession, path: str) -> DataFrame:
    """Records of the log; blank and corrupt lines are skipped (``lineage_lines``
    has those)."""
    return lineage_lines(spark, path).where(~F.col("omitida")).select(*LINEAGE.fieldNames())


def read_jdbc(
    spark: SparkSession,
    url: str,
    table_or_query: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    num_partitions: int = 32,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Table or query of a relational database.

    With a partition column the scan is split in ranges and runs on all
    executors; without one a single task reads everything, which suits
    dimension tables only.
    """
    return spark.read.format("jdbc").options(
        **jdbc_options(
            url, table_or_query, properties, partition_column, bounds, num_partitions, fetch_size
        )
    ).load()


def jdbc_options(
    url: str,
    table_or_query: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    num_partitions: int = 32,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    is_query = table_or_query.lstrip().lower().startswith(("select", "with"))
    options = {"url": url, "fetchsize": str(fetch_size), **(properties or {})}
    if partition_column:
        if bounds is None:
            raise ValueError("a partitioned scan needs the bounds of its column")
        # partitioned scans take a table expression only
        options["dbtable"] = f"({table_or_query}) AS q" if is_query else table_or_query
        options["partitionColumn"] = partition_column
        options["lowerBound"], options["upperBound"] = map(str, bounds)
        options["numPartitions"] = str(num_partitions)
    else:
        options["query" if is_query else "dbtable"] = table_or_query
    return options


def read_nested(spark: SparkSession, path: str, schema, array: str, inner: str) -> DataFrame:
    """Rows of a nested JSON document: one per entry of the ``inner`` array within
    each entry of ``array``, with the other fields of both."""
    document = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    outer = document.select(F.explode(array).alias("_o"))
    fields = outer.schema["_o"].dataType.fieldNames()
    kept = [F.col(f"_o.{name}").alias(name) for name in fields if name != inner]
    return outer.select(*kept, F.explode(f"_o.{inner}").alias("_i")).select(*[f for f in fields if f != inner], "_i.*")
