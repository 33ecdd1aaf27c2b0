"""Rule semantics, each on a hand-made feed."""

import pytest
from pyspark.sql import functions as F

from mercadal.functions.layouts import LAYOUTS
from mercadal.functions.scalars import labelled_id
from mercadal.operators import joins
from mercadal.operators import rules as R
from mercadal.operators.joins import anti_join, lookup_join, semi_join
from mercadal.operators.quality import apply_rules, first_rows
from mercadal.plans import silver
from mercadal.schemas import EVENT_COLUMNS, ORDINAL, TRANSACTION_COLUMNS
from mercadal.session import local_table

AS_OF = "2026-06-01 00:00:00"
TXN = {
    "transaction_id": "TXN-000001", "user_id": "U1", "product_id": "P1", "category": "Ropa",
    "amount": "10.0", "quantity": "1", "date": "2024-03-01 00:00:00",
    "payment_method": "efectivo", "status": "completada", "country": "CL",
}
EVT = {
    "event_id": "EVT-0000001", "user_id": "U1", "session_id": "S1", "event_type": "click",
    "page": "/p", "timestamp": "2024-03-01 00:00:00", "device": "mobile", "browser": "Edge",
    "duration_sec": "1.0",
}


def feed(spark, base, columns, changes):
    rows = []
    for i, change in enumerate(changes):
        row = {**base, **change}
        rows.append((*[row[c] for c in columns], row.get("_file", "a"), 0, i))
    schema = ", ".join(f"{c} string" for c in columns)
    return local_table(spark, rows, f"{schema}, _file string, _block_start long, _row_id long")


def transactions(spark, *changes):
    numbered = [{"transaction_id": f"TXN-{i:06d}", **c} for i, c in enumerate(changes)]
    return silver.validate_transactions(feed(spark, TXN, TRANSACTION_COLUMNS, numbered), AS_OF)


def events(spark, users, *changes):
    numbered = [{"event_id": f"EVT-{i:07d}", **c} for i, c in enumerate(changes)]
    known = local_table(spark, [(u,) for u in users], "user_id string")
    return silver.validate_events(feed(spark, EVT, EVENT_COLUMNS, numbered), known, AS_OF)


def counts(result):
    return {r.rule: r.violations for r in result.report.collect()}


def test_unparsable_values_become_null(spark):
    clean, result = transactions(
        spark, {"amount": "abc"}, {"date": "2024-13-01 00:00:00"}, {"amount": "inf"}, {}
    )
    assert counts(result)["R01"] == 3
    row = clean.first()
    assert (row.year, row.month, row.quantity, row.amount) == (2024, 3, 1, 10.0)
    assert not set(ORDINAL) & set(clean.columns)


def test_first_copy_invalid_drops_all(spark):
    same = "TXN-000009"
    clean, result = transactions(
        spark, {"transaction_id": same, "amount": "-1"}, {"transaction_id": same}
    )
    found = counts(result)
    assert (found["R02"], found["R03a"], clean.count()) == (1, 1, 0)


def test_first_copy_is_in_file_order(spark):
    same = "TXN-000009"
    clean, result = transactions(
        spark,
        {"transaction_id": same, "_file": "c", "user_id": "third"},
        {"transaction_id": same, "_file": "a", "user_id": "first"},
        {"transaction_id": same, "_file": "b", "user_id": "second"},
    )
    assert counts(result)["R02"] == 2
    assert [r.user_id for r in clean.collect()] == ["first"]


def test_null_keys_are_equal_and_malformed(spark):
    _, result = events(spark, ["U1"], {"event_id": None}, {"event_id": None}, {})
    found = counts(result)
    assert (found["R01"], found["R02"], found["R07"]) == (2, 1, 2)


def test_null_enum_passes_empty_fails(spark):
    clean, result = transactions(spark, {"category": None}, {"category": ""}, {})
    assert counts(result)["R04a"] == 1
    assert clean.count() == 2


def test_id_format(spark):
    _, result = transactions(
        spark, {"transaction_id": "TXN-12345"}, {"transaction_id": "TXN-1234567"},
        {"transaction_id": None}, {},
    )
    assert counts(result)["R07"] == 3


def test_null_quantity_is_kept_or_fails(spark):
    clean, _ = transactions(spark, {"quantity": ""})
    assert clean.first().quantity is None
    raw = feed(spark, TXN, TRANSACTION_COLUMNS, [{"quantity": "x"}])
    strict, _ = silver.validate_transactions(raw, AS_OF, strict=True)
    with pytest.raises(Exception):
        strict.collect()


def test_future_is_strict(spark):
    _, result = events(
        spark, ["U1"], {"timestamp": AS_OF}, {"timestamp": "2026-06-01 00:00:01"}
    )
    assert counts(result)["R05"] == 1


def test_reference_rule(spark):
    _, result = events(spark, ["U1"], {}, {"user_id": "U2"}, {"user_id": None})
    found = counts(result)
    assert (found["R06"], found["R01"]) == (1, 1)


def test_outlier_is_reported_not_dropped(spark):
    clean, result = transactions(spark, *[{"amount": a} for a in ("1", "2", "3", "4", "100")])
    row = result.report.where("rule = 'R08'").first()
    assert (row.violations, row.action) == (1, "report")
    assert row.description.endswith("(> 10.00)")
    assert clean.count() == 5
    stats = result.stats.first()
    assert (stats.rows_in, stats.rows_out, stats.max_value, stats.mean_value) == (5, 5, 100, 22)


def test_empty_feed(spark):
    clean, result = transactions(spark)
    assert clean.count() == 0
    assert {r.pct for r in result.report.collect()} == {0.0}
    assert result.stats.first().reject_pct == 0.0


def test_report_equals_counts_per_rule(spark):
    _, result = transactions(
        spark, {"amount": "-5", "quantity": "0"}, {"category": "x"}, {"payment_method": "y"}, {}
    )
    flagged = result.flagged
    for rule in result.rules:
        assert counts(result)[rule.id] == flagged.where(F.col(rule.flag)).count()
    assert result.stats.first().reject_pct == 75.0


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_result_ignores_partitioning(spark, partitions):
    rows = [{"transaction_id": f"TXN-{i % 40:06d}", "amount": str(i)} for i in range(100)]
    raw = feed(spark, TXN, TRANSACTION_COLUMNS, rows).repartition(partitions)
    clean, result = silver.validate_transactions(raw, AS_OF)
    assert counts(result)["R02"] == 60
    assert {r.amount for r in clean.select("amount").collect()} == set(map(float, range(1, 40)))


def skewed(spark, n=30_000):
    """A third of the rows under key 0, another share under null."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, F.col("id"))
    return spark.range(0, n, 1, 6).select(key.alias("k"), F.col("id").alias("v"))


@pytest.mark.parametrize("n", [300, 30_000])
def test_keys_are_split_by_share_at_any_size(spark, n):
    pieces = sorted(joins.frequent_keys(skewed(spark, n), ["k"]), key=lambda r: -r[1])[:2]
    assert all(abs(got - joins.PIECES / 3) < 2 for _, got in pieces)


def test_lookup_join_on_hot_and_null_keys(spark):
    fact = skewed(spark)
    lookup = local_table(
        spark, [(0, "zero"), (4, "four"), (None, "null"), (-1, "no rows")], "k long, name string"
    )
    joined = lookup_join(fact, lookup, ["k"], ["name"])
    assert joined.columns == ["k", "v", "name"]
    assert joined.count() == 30_000 and joined.select("v").distinct().count() == 30_000
    found = {r.name: r["count"] for r in joined.groupBy("name").count().collect()}
    assert found == {"zero": 10_000, "four": 1, "null": 10_000, None: 9_999}


def test_hot_key_is_spread_over_tasks(spark):
    """With broadcasting off, no task of the join gets the whole hot key."""
    hot = dict(joins.frequent_keys(skewed(spark), ["k"]))
    assert sorted(hot.values())[-2] > joins.PIECES / 4
    assert len(hot) <= joins.HOT_KEYS and sum(hot.values()) <= joins.PIECES + joins.HOT_KEYS
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        lookup = skewed(spark).select("k").distinct().withColumn("hit", F.lit(True))
        joined = lookup_join(skewed(spark), lookup, ["k"], ["hit"])
        sizes = joined.where("k = 0").groupBy(F.spark_partition_id()).count().collect()
        assert joined.where("hit").count() == 30_000
        assert len(sizes) == 8 and max(r["count"] for r in sizes) < 2_500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_many_frequent_keys_stay_bounded(spark):
    fact = spark.range(0, 20_000, 1, 4).select(F.pmod("id", F.lit(500)).alias("k"), "id")
    hot = joins.frequent_keys(fact, ["k"])
    assert 0 < len(hot) <= joins.HOT_KEYS
    lookup = spark.range(0, 500, 2).select(F.col("id").alias("k"), F.lit("even").alias("t"))
    joined = lookup_join(fact, lookup, ["k"], ["t"])
    assert joined.count() == 20_000 and joined.where("t is not null").count() == 10_000


def test_rules_with_split_keys(spark):
    """A third of the rows share one id and one user."""
    rows = [
        {"transaction_id": "TXN-000000" if i % 3 == 0 else f"TXN-{i:06d}", "amount": str(i + 1)}
        for i in range(300)
    ]
    clean, result = silver.validate_transactions(
        feed(spark, TXN, TRANSACTION_COLUMNS, rows), AS_OF
    )
    assert counts(result)["R02"] == 99 and clean.count() == 201
    assert clean.where("transaction_id = 'TXN-000000'").first().amount == 1.0
    visits = [{"event_id": f"EVT-{i:07d}", "user_id": "U1" if i % 3 else "U2"} for i in range(300)]
    known = local_table(spark, [("U1",)], "user_id string")
    _, result = silver.validate_events(feed(spark, EVT, EVENT_COLUMNS, visits), known, AS_OF)
    assert counts(result)["R06"] == 100


def test_semi_and_anti_join(spark):
    fact = local_table(spark, [(1,), (2,), (2,), (None,)], "k int")
    members = local_table(spark, [(2,), (2,), (None,)], "m int")
    assert [r.k for r in semi_join(fact, members, "k", "m").collect()] == [2, 2]
    assert [r.k for r in anti_join(fact, members, "k", "m").collect()] == [1]


def test_first_rows(spark):
    rows = local_table(spark, [("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z")], "k string, n int, t string")
    kept = {(r.k, r.n, r.t) for r in first_rows(rows, ["k"], ["n", "t"]).collect()}
    assert kept == {("a", 1, "y"), ("b", 5, "z")}


def test_constraints_of_the_sales_star(spark):
    from mercadal.operators.quality import apply_rules
    from mercadal.schemas import product_rules, sales_rules
    from mercadal.sources.datagen import product_dimension, synthetic_sales

    place = [F.lit("f").alias("_file"), F.lit(0).alias("_block_start")]
    products = product_dimension(spark).select(
        "*", *place, F.monotonically_increasing_id().alias("_row_id")
    )
    assert set(counts(apply_rules(products, product_rules(), AS_OF)).values()) == {0}
    sales = synthetic_sales(spark, 500).select(
        "*", *place, F.monotonically_increasing_id().alias("_row_id")
    )
    refs = {"productos": products.where("id <> 3")}
    found = counts(apply_rules(sales, sales_rules(), AS_OF, refs))
    expected = sales.where("producto_id = 3").count()
    assert expected > 0 and found == {"NN": 0, "PK": 0, "FK": expected, "CK": 0}


def test_key_rules_with_hot_keys_need_no_job_and_no_sort_aggregate(spark):
    """A third of the rows share one key, another third one unknown reference."""
    rows = []
    for i in range(9000):
        key = 7 if i % 3 == 0 else 100 + i
        user = -1 if i % 3 == 1 else i % 50
        rows.append((key, None if i % 97 == 0 else user, f"f{9 - i % 10}", i // 4000, i))
    rows += rows[:40]  # full copies, place included, stand first together
    df = local_table(
        spark, rows, "k long, u long, _file string, _block_start long, _row_id long"
    ).repartition(7)
    known = local_table(spark, [(u,) for u in range(0, 50, 2)] * 2 + [(None,)], "u long")
    rules = [
        R.first_occurrence("PK", ["k"], ["_file", "_block_start", "_row_id"], "repeated"),
        R.references("FK", "u", "users", "u", "unknown"),
    ]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("key-rules", "")
    flagged = apply_rules(df, rules, "2024-01-01", {"users": known}).flagged
    assert not tracker.getJobIdsForGroup("key-rules")
    spark.sparkContext._jsc.clearJobGroup()
    assert "SortAggregate" not in flagged._jdf.queryExecution().executedPlan().toString()

    first = {}
    for k, _, *place in rows:
        first[k] = min(first.get(k, tuple(place)), tuple(place))
    wanted = sorted(
        (k, -2 if u is None else u, *place, tuple(place) > first[k], u is not None and (u < 0 or u % 2 == 1))
        for k, u, *place in rows
    )
    got = sorted((r.k, -2 if r.u is None else r.u, r._file, r._block_start, r._row_id, r._v_PK, r._v_FK) for r in flagged.collect())
    assert got == wanted


def test_place_of_a_row_ignores_the_task_that_read_it(spark):
    """Row numbers of text feeds carry the task in their upper bits."""
    task = 1 << 33
    rows = [(1, "a", "b.csv", 0, 2), (1, "z", "a.csv", 100, 5 * task + 1), (1, "y", "a.csv", 100, 5 * task), (1, "c", "a.csv", 200, 0)]
    df = local_table(spark, rows, "k long, v string, _file string, _block_start long, _row_id long")
    rule = R.first_occurrence("PK", ["k"], ["_file", "_block_start", "_row_id"], "repeated")
    result = apply_rules(df, [rule], "2024-01-01")
    assert [r.v for r in result.clean.collect()] == ["y"]
    empty = apply_rules(df.where("false"), [rule], "2024-01-01")
    assert empty.clean.count() == 0 and empty.summary.first().rows_in == 0


def test_stored_rules_judge_once_and_leave_rows_in_place(spark):
    """Clean rows and report read the same written flags, no rule is planned again
    for them, and the rows are not shuffled to meet the few keys looked up."""
    changes = [{"transaction_id": f"TXN-{i % 40:06d}", "amount": str(i + 1)} for i in range(60)]
    changes += [{"transaction_id": None}, {"transaction_id": None}, {"amount": "x"}, {"amount": "1e999"}]
    raw = feed(spark, TXN, TRANSACTION_COLUMNS, [{"transaction_id": f"TXN-9{i:05d}", **c} for i, c in enumerate(changes)])
    lazy_clean, lazy = silver.validate_transactions(raw, AS_OF)
    clean, result = silver.validate_transactions(raw, AS_OF, store=True)
    assert sorted(map(str, clean.collect())) == sorted(map(str, lazy_clean.collect()))
    assert result.report.collect() == lazy.report.collect()
    assert result.stats.collect() == lazy.stats.collect()
    for frame in (clean, result.flagged):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan and "RLIKE" not in plan

    users = local_table(spark, [("U1",), ("U2",)], "user_id string")
    visits = [{"event_id": f"EVT-{i:07d}", "user_id": u} for i, u in enumerate(["U1", None, "U7", "U2", "U7"])]
    raw = feed(spark, EVT, EVENT_COLUMNS, visits)
    lazy_clean, lazy = silver.validate_events(raw, users, AS_OF)
    clean, result = silver.validate_events(raw, users, AS_OF, store=True)
    assert sorted(map(str, clean.collect())) == sorted(map(str, lazy_clean.collect()))
    assert result.report.collect() == lazy.report.collect() and result.stats.collect() == lazy.stats.collect()


def test_ids_are_padded_as_the_formatter_does(spark):
    values = [0, 7, 123456, 1234567, -5, -1234567, None, 2**63 - 1, -(2**63)]
    frame = local_table(spark, [(v,) for v in values], "v long")
    got = frame.select(labelled_id("T-", F.col("v"), 6).alias("a"), F.format_string("T-%06d", "v").alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got]


def test_stamps_are_told_apart_by_their_whole_pattern(spark):
    """The cheap tests of length and signs lose no value that the pattern reads."""
    texts = [
        "2024-01-31 10:00:00", "2024-01-31 10:00:00\r\n", "2024-01-31T10:00:00Z\n", "2024-01-31 10:00:00.123456\n",
        "2024-02-31 10:00:00", "31/01/2024", "01/31/2024\n", "2024/01/31T10:00:00.5Z\r\n", "2024-01-31\n\n", "2024-01-31 1:00:00", None, "",
    ]
    rows = local_table(spark, [(t,) for t in texts], "t string")
    for layout in LAYOUTS:
        ordered = F.regexp_replace("t", layout.pattern, layout.iso)
        whole = F.when(F.col("t").rlike(layout.pattern), ordered.try_cast("timestamp_ntz"))
        assert not rows.where(~layout.stamp(F.col("t")).eqNullSafe(whole)).count(), layout.name
