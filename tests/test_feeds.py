"""Layouts of stamps and planted faults."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from mercadal.functions.layouts import DEFAULT, LAYOUTS, UndecidedLayout, feed_layout, feed_layouts, layout_counts
from mercadal.operators.faults import MODULUS, STEP, Copies, Fault, with_faults
from mercadal.plans.pipeline import PipelineConfig, run_pipeline
from mercadal.plans.silver import typed_events
from mercadal.session import local_table

BY_NAME = {layout.name: layout for layout in LAYOUTS}


def feed(spark, texts):
    return local_table(spark, [(t,) for t in texts], "stamp string")


def read(spark, layout, texts):
    rows = feed(spark, texts).select(layout.stamp(F.col("stamp")).alias("at")).collect()
    return [r.at for r in rows]


@pytest.mark.parametrize(
    ("text", "name"),
    [
        ("2024-03-25 10:20:30", "yyyy-MM-dd HH:mm:ss"),
        ("2024-03-25T10:20:30", "yyyy-MM-ddTHH:mm:ss"),
        ("2024-03-25T10:20:30Z", "yyyy-MM-ddTHH:mm:ss"),
        ("2024-03-25 10:20:30.000", "yyyy-MM-dd HH:mm:ss.S"),
        ("2024/03/25 10:20:30", "yyyy/MM/dd HH:mm:ss"),
        ("25/03/2024 10:20:30", "dd/MM/yyyy HH:mm:ss"),
        ("03/25/2024 10:20:30", "MM/dd/yyyy HH:mm:ss"),
    ],
)
def test_every_layout_is_found_and_read(spark, text, name):
    found = feed_layout(feed(spark, [text, None, "", "  ", "no stamp"]), "stamp")
    assert found.name == name
    assert read(spark, found, [text, "no stamp", None]) == [dt.datetime(2024, 3, 25, 10, 20, 30), None, None]


def test_dates_alone_and_days_the_calendar_lacks(spark):
    found = feed_layout(feed(spark, ["2024-02-29", "2024-12-31", "2023-02-29"]), "stamp")
    assert found.name == "yyyy-MM-dd"
    assert read(spark, found, ["2024-02-29", "2023-02-29", "2024-13-01", "2024-02-29 10:00:00", " 2024-02-29"]) == [dt.datetime(2024, 2, 29), None, None, None, None]


def test_one_day_above_twelve_tells_day_from_month(spark):
    same = ["01/02/2024"] * 50
    assert feed_layout(feed(spark, [*same, "13/02/2024"]), "stamp").name == "dd/MM/yyyy"
    assert feed_layout(feed(spark, [*same, "02/13/2024"]), "stamp").name == "MM/dd/yyyy"
    with pytest.raises(UndecidedLayout, match="dd/MM/yyyy and MM/dd/yyyy each read 50 of 51"):
        feed_layout(feed(spark, [*same, "x"]), "stamp")


def test_unknown_and_empty_feeds(spark):
    with pytest.raises(UndecidedLayout, match="no known layout reads any of 2 stamps"):
        feed_layout(feed(spark, ["yesterday", "20240325", None]), "stamp")
    assert feed_layout(feed(spark, []), "stamp") == DEFAULT
    assert feed_layout(feed(spark, [None, " "]), "stamp") == DEFAULT


def test_feeds_are_decided_one_by_one_under_any_partitioning(spark):
    rows = [("a", f"{d:02d}/01/2024") for d in range(1, 29)] + [("b", f"01/{d:02d}/2024") for d in range(1, 29)] + [(None, "2024-01-01")]
    frame = local_table(spark, rows, "feed string, stamp string")
    for parts in (1, 7):
        found = feed_layouts(frame.repartition(parts), "stamp", ["feed"])
        assert {k[0]: v.name for k, v in found.items()} == {"a": "dd/MM/yyyy", "b": "MM/dd/yyyy", None: "yyyy-MM-dd"}
    counts = {(r.feed, r.layout): (r.n_read, r.n_values) for r in layout_counts(frame, "stamp", ["feed"]).collect()}
    assert counts["a", "dd/MM/yyyy"] == (28, 28) and counts["a", "MM/dd/yyyy"] == (12, 28)


def test_silver_reads_the_layout_of_its_feed(spark):
    rows = local_table(spark, [("5", "25/03/2024 10:20:30"), ("x", "2024-03-25 10:20:30")], "duration_sec string, timestamp string")
    layout = feed_layout(rows.limit(1), "timestamp")
    got = typed_events(rows, layout).collect()
    assert [r.timestamp for r in got] == [dt.datetime(2024, 3, 25, 10, 20, 30), None]


def test_a_run_on_feeds_in_other_layouts_keeps_its_rows(spark, tmp_path):
    plain = PipelineConfig(root=str(tmp_path / "a"), as_of="2026-06-01 00:00:00", transactions=300, events=400)
    first = run_pipeline(spark, plain)
    for feed_name, pattern, form in (
        ("transacciones.csv", r"(\d{4})-(\d\d)-(\d\d) (\d\d:)", r"\3/\2/\1 \4"),
        ("eventos.jsonl", r"(\d{4}-\d\d-\d\d) (\d\d:)", r"\1T\2"),
    ):
        (tmp_path / "feeds" / feed_name).mkdir(parents=True)
        for part in (tmp_path / "a" / "seeds" / feed_name).glob("part-*"):
            (tmp_path / "feeds" / feed_name / part.name).write_text(re.sub(pattern, form, part.read_text()))
    again = run_pipeline(
        spark,
        PipelineConfig(root=str(tmp_path / "b"), as_of="2026-06-01 00:00:00", transactions_path=f"{tmp_path}/feeds/transacciones.csv", events_path=f"{tmp_path}/feeds/eventos.jsonl"),
    )
    for name in ("transacciones", "eventos"):
        assert again.silver[name].count() == first.silver[name].count() > 100
    stored = {r.feed: r.formato for r in spark.read.json(f"{tmp_path}/b/metadata/formatos").collect()}
    assert stored == {"transacciones": "dd/MM/yyyy HH:mm:ss", "eventos": "yyyy-MM-ddTHH:mm:ss"}


def test_faults_depend_on_keys_alone(spark):
    rows = spark.range(2000).select("id", (F.col("id") % 7).cast("int").alias("n"), F.lit("t").alias("t"))
    faults = [Fault("n", 5, 1), Fault("n", 7, 2, -1), Fault("t", 11, 3, "bad"), Copies(13, 4, 2)]
    want = []
    for k in range(2000):
        d = k % MODULUS * STEP % MODULUS
        n = -1 if d % 7 == 2 else None if d % 5 == 1 else k % 7
        want += [(k, n, "bad" if d % 11 == 3 else "t", c) for c in range(3 if d % 13 == 4 else 1)]
    for parts in (1, 5):
        got = with_faults(rows.repartition(parts), F.col("id"), faults)
        assert sorted(map(tuple, got.collect()), key=lambda r: (r[0], r[3])) == want
    assert got.schema["n"].dataType.simpleString() == "int"
    odd = local_table(spark, [(None, 1, "t"), (-5, 1, "t")], "id long, n int, t string")
    assert with_faults(odd, F.col("id"), faults).count() >= 2
    assert with_faults(rows.limit(0), F.col("id"), faults).count() == 0
