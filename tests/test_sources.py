import json

import pytest
from pyspark.sql import functions as F

from mercadal.operators.quality import apply_rules
from mercadal.operators.rules import not_null
from mercadal.plans import governance, silver
from mercadal.schemas import (
    CATEGORIES,
    EVENT_FEED,
    TRANSACTION_COLUMNS,
    TRANSACTION_FEED,
    all_text,
)
from mercadal.session import local_table, scratch_root
from mercadal.sources import datagen, readers, writers

AS_OF = "2026-06-01 00:00:00"


def txn_line(**changes):
    row = {
        "transaction_id": "TXN-000001", "user_id": "USR-0001", "product_id": "PRD-0001",
        "category": "Ropa", "amount": "10.0", "quantity": "1", "date": "2024-03-01 00:00:00",
        "payment_method": "efectivo", "status": "completada", "country": "CL",
    }
    row.update(changes)
    return ",".join(row[c] for c in TRANSACTION_COLUMNS)


def write_text(path, lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


HEADER = ",".join(TRANSACTION_COLUMNS)


def test_csv_empty_fields(spark, tmp_path):
    path = write_text(tmp_path / "t.csv", [HEADER, txn_line(user_id="", country="")])
    parity = readers.read_csv(spark, path, TRANSACTION_FEED)
    row = parity.first()
    assert (row.user_id, row.country, row._source_file) == ("", "", "t.csv")
    assert row._ingested_at.endswith("+00:00")
    _, result = silver.validate_transactions(parity, AS_OF)
    assert result.report.where("rule = 'R01'").first().violations == 0
    strict = readers.read_csv(spark, path, TRANSACTION_FEED, empty_as_null=True)
    _, result = silver.validate_transactions(strict, AS_OF)
    assert result.report.where("rule = 'R01'").first().violations == 1


def test_csv_header_must_agree(spark, tmp_path):
    path = write_text(tmp_path / "t.csv", ["a,b", "1,2"])
    with pytest.raises(Exception):
        readers.read_csv(spark, path, all_text(["b", "a"])).collect()


def test_csv_separator_and_quotes(spark, tmp_path):
    path = write_text(tmp_path / "t.csv", ["a;b", '"x;""y""";2'])
    row = readers.read_source(spark, path, "csv", all_text(["a", "b"]), sep=";").first()
    assert (row.a, row.b) == ('x;"y"', "2")


def test_jsonl_nulls_blanks_and_numbers(spark, tmp_path):
    lines = [
        json.dumps({"event_id": "E1", "user_id": None, "duration_sec": 1.5}),
        "",
        json.dumps({"event_id": "E2", "user_id": "None", "page": "/p"}),
    ]
    path = write_text(tmp_path / "e.jsonl", lines)
    rows = {r.event_id: r for r in readers.read_jsonl(spark, path, EVENT_FEED).collect()}
    assert set(rows) == {"E1", "E2"}
    assert rows["E1"].user_id is None and rows["E1"].duration_sec == "1.5"
    assert rows["E2"].user_id is None and rows["E2"].duration_sec is None


def test_jsonl_malformed_line_fails(spark, tmp_path):
    path = write_text(tmp_path / "e.jsonl", ['{"event_id": "E1"}', "{bad"])
    with pytest.raises(Exception):
        readers.read_jsonl(spark, path, EVENT_FEED).collect()


def test_unknown_format(spark):
    with pytest.raises(ValueError):
        readers.read_source(spark, "x", "xml", EVENT_FEED)


def test_lineage_tolerates_corrupt_lines(spark, tmp_path):
    path = str(tmp_path / "linaje")
    assert readers.read_lineage(spark, path).count() == 0
    governance.log_lineage(
        spark, path,
        {"origin": "a\\b/c.csv", "step": "s", "target": "x/y", "script": "z.py",
         "rows_in": 5, "rows_out": 3},
    )
    governance.log_lineage(
        spark, path,
        {"origin": "a", "step": "s", "target": "b", "script": "z", "rows_in": 1, "rows_out": 9},
    )
    (tmp_path / "linaje" / "part-bad.json").write_text("\n{bad\n")
    log = readers.read_lineage(spark, path)
    table = {r.origen: r for r in governance.lineage_table(log).collect()}
    assert table["c.csv"].filas_eliminadas == 2 and len(table["c.csv"].timestamp_utc) == 19
    assert table["a"].filas_eliminadas == 0
    total = governance.lineage_summary(log).first()
    assert (total.pasos, total.filas_entrada, total.filas_salida) == (2, 6, 12)
    (tmp_path / "linaje" / "part-odd.json").write_text('  \n5\n{"origen": "cut off\n\t\n{"filas_salida": "many"}\n')
    lines = readers.lineage_lines(spark, path)
    skipped = sorted(r.linea for r in lines.where("omitida").collect())
    assert skipped == ["5", '{"filas_salida": "many"}', '{"origen": "cut off', "{bad"]
    assert readers.read_lineage(spark, path).count() == 2
    assert readers.lineage_lines(spark, str(tmp_path / "none")).count() == 0


def test_partition_overwrite_keeps_other_months(spark, tmp_path):
    path = str(tmp_path / "zone")
    rows = local_table(
        spark, [(1, 2024, 1), (2, 2024, 2)], "id int, year int, month int"
    )
    writers.write_zone(rows, path, ["year", "month"])
    again = rows.where("month = 1").withColumn("id", F.lit(9))
    zone = writers.write_zone(again, path, ["year", "month"])
    assert {(r.id, r.month) for r in zone.collect()} == {(9, 1), (2, 2)}


def test_raw_archive_keeps_every_line(spark, tmp_path):
    path = write_text(tmp_path / "t.csv", [HEADER, txn_line(), txn_line(user_id="")])
    archived = writers.archive_raw(spark, path, str(tmp_path / "raw"))
    lines = [r.value for r in archived.orderBy("_block_start", "_row_id").collect()]
    assert lines == [HEADER, txn_line(), txn_line(user_id="")]


def test_idempotent_and_single_load(spark, tmp_path):
    rows = local_table(spark, [(1, "a"), (2, "b")], "id int, v string")
    path = str(tmp_path / "load")
    writers.append_new(rows.where("id = 1"), path, "id")
    writers.append_new(rows, path, "id")
    assert writers.append_new(rows, path, "id").count() == 2
    once = str(tmp_path / "once")
    writers.load_once(rows, once)
    assert writers.load_once(rows, once).count() == 2
    empty = str(tmp_path / "empty")
    writers.load_once(rows.where("false"), empty)
    assert writers.load_once(rows, empty).count() == 2
    twice = str(tmp_path / "twice")
    assert writers.append_new(rows.unionByName(rows), twice, "id").count() == 2
    more = rows.unionByName(rows.withColumn("id", F.col("id") + 10))
    assert writers.append_new(more.unionByName(more), twice, "id").count() == 4


def test_query_results_skip_other_objects(spark, tmp_path):
    frame = local_table(spark, [(1,)], "id int")
    written = writers.write_query_results({"a": frame, "b": {"no": "frame"}}, str(tmp_path))
    assert [p.rsplit("/", 1)[1] for p in written] == ["query_a.parquet"]


def test_sample_export_is_one_sorted_file(spark, tmp_path):
    rows = spark.range(2000).select(
        F.col("id"), F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("id", F.lit(7)).cast("int")).alias("fecha")
    )
    path = tmp_path / "sample"
    writers.export_sample(rows, ["fecha", "id"], str(path))
    files = list(path.glob("part-*.csv"))
    assert len(files) == 1
    lines = files[0].read_text().splitlines()
    assert len(lines) == 501 and lines[1].startswith("0,2024-01-01")


def test_surrogate_keys_resolve(spark):
    names = local_table(spark, [("b",), ("a",), ("c",)], "nombre string")
    keys = writers.assign_keys(names, "nombre")
    assert {(r.nombre, r.id) for r in keys.collect()} == {("a", 1), ("b", 2), ("c", 3)}
    fact = local_table(spark, [("a", 1), ("z", 2)], "nombre string, n int")
    found = {r.nombre: r.id for r in writers.resolve_keys(fact, keys, "nombre", "id").collect()}
    assert found == {"a": 1, "z": None}


def test_jdbc_options():
    plain = readers.jdbc_options("jdbc:x", "select 1")
    assert plain["query"] == "select 1" and "dbtable" not in plain
    split = readers.jdbc_options("jdbc:x", "ventas.transacciones", None, "id", ("1", "100"), 8)
    assert split["dbtable"] == "ventas.transacciones"
    assert (split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("1", "100", "8")
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x", "t", partition_column="id")


class _Conf(dict):
    pass


class _Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder + "/own"


class _Session:
    def __init__(self, conf, context):
        self.conf, self.sparkContext = conf, context


def test_scratch_root_reads_the_session():
    named = _Session(_Conf({"spark.checkpoint.dir": "hdfs://x/y/"}), _Context("yarn"))
    assert scratch_root(named) == "hdfs://x/y"
    given = _Session(_Conf(), _Context("yarn", "hdfs://x/z"))
    assert scratch_root(given) == "hdfs://x/z"
    with pytest.raises(RuntimeError):
        scratch_root(_Session(_Conf(), _Context("yarn")))
    local = _Session(_Conf(), _Context("local[2]"))
    assert scratch_root(local).endswith("/own") and scratch_root(local) == scratch_root(local)


def test_synthetic_transactions_fault_rates(spark):
    n = 20_000
    rows = datagen.synthetic_transactions(spark, n, with_truth=True)
    share = rows.agg(
        *[
            F.avg(F.col(c).cast("double")).alias(c)
            for c in ("_bad_category", "_bad_payment", "_bad_amount", "_bad_quantity",
                      "_future", "_repeated")
        ],
        F.avg(F.col("user_id").isNull().cast("double")).alias("no_user"),
        F.avg(F.col("country").isNull().cast("double")).alias("no_country"),
        F.avg((F.col("amount") < 0).cast("double")).alias("negative"),
    ).first()
    expected = {
        "_bad_category": 0.015, "_bad_payment": 0.015, "_bad_amount": 0.02,
        "_bad_quantity": 0.01, "_future": 0.01, "_repeated": 0.01, "no_user": 0.02,
        "no_country": 0.01, "negative": 0.02,
    }
    for name, rate in expected.items():
        assert abs(share[name] - rate) < 0.004, name
    clean = rows.where(~F.col("_bad_category") & ~F.col("_bad_amount"))
    assert {r.category for r in clean.select("category").distinct().collect()} == set(CATEGORIES)
    bounds = clean.agg(F.min("amount"), F.max("amount")).first()
    assert bounds[0] >= 1.0 and bounds[1] <= 2000.0


def test_synthetic_data_ignores_partitioning(spark):
    one = datagen.synthetic_events(spark, 500).orderBy("event_id", "session_id").collect()
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "3")
    try:
        two = datagen.synthetic_events(spark, 500).orderBy("event_id", "session_id").collect()
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
    assert one == two


def test_synthetic_sales(spark):
    sales = datagen.synthetic_sales(spark, 3000)
    assert sales.count() == 3000
    shares = {r.canal: r["count"] / 3000 for r in sales.groupBy("canal").count().collect()}
    assert abs(shares["online"] - 0.5) < 0.04 and abs(shares["b2b"] - 0.15) < 0.03
    span = sales.agg(F.min("fecha"), F.max("fecha"), F.min("cantidad"), F.max("cantidad")).first()
    assert str(span[0]) >= "2024-01-01" and str(span[1]) <= "2024-12-31"
    assert (span[2], span[3]) == (1, 10)
    assert dict(sales.dtypes)["total"] == "decimal(12,2)"


def test_report_document(spark, tmp_path):
    rows = local_table(spark, [(1, None), (2, "x")], "id int, v string")
    result = apply_rules(rows, [not_null("R01", ["v"], "null v")], AS_OF)
    writers.write_quality_report({"d": result.report}, {"d": result.stats}, str(tmp_path))
    document = spark.read.json(str(tmp_path / "reporte_calidad" / "d")).first()
    assert document.estadisticas.rows_in == 2 and document.estadisticas.reject_pct == 50.0
    assert document.reglas[0].rule == "R01" and document.reglas[0].violations == 1


def test_catalog_document(spark, tmp_path):
    governance.write_catalog(spark, str(tmp_path / "cat"))
    document = spark.read.json(str(tmp_path / "cat")).first()
    assert [f.nombre for f in document.fuentes] == ["transacciones", "eventos"]
    assert sum(len(f.campos) for f in document.fuentes) == 19
    assert len(document.tablas_gold) == 3 and len(document.reglas_calidad) == 11
    keys = [c.campo for f in document.fuentes for c in f.campos if c.clave_primaria]
    assert keys == ["transaction_id", "event_id"]
