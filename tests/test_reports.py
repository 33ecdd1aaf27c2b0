import pytest
from pyspark.sql import functions as F

from mercadal.functions import scalars as S
from mercadal.functions.kernel import trig_kernel, trig_kernel_arrow
from mercadal.operators import aggregates, scaling, scoring
from mercadal.plans import analytics, gold, sales
from mercadal.session import local_table
from mercadal.sources.datagen import product_dimension, synthetic_sales, write_star

# The published score matrix and weights, fixed values.
WEIGHTS = {
    "rendimiento": 12, "costo": 15, "escalabilidad": 13, "mantenibilidad": 10,
    "reproducibilidad": 10, "gobernanza": 8, "seguridad": 8, "resiliencia": 8,
    "complejidad": 8, "madurez": 8,
}
MATRIX = {
    "rendimiento": (2, 3, 3, 4, 5), "costo": (5, 4, 3, 2, 1), "escalabilidad": (1, 2, 3, 4, 5),
    "mantenibilidad": (3, 4, 3, 2, 3), "reproducibilidad": (2, 5, 4, 3, 3),
    "gobernanza": (2, 3, 3, 4, 5), "seguridad": (2, 3, 3, 4, 5), "resiliencia": (1, 2, 3, 4, 5),
    "complejidad": (5, 4, 3, 2, 1), "madurez": (5, 3, 3, 2, 1),
}
# The published run times, fixed values.
RUNS = [
    ("doc", 1, 18.3241), ("doc", 1, 18.2987), ("doc", 1, 18.3104),
    ("doc", 2, 9.804), ("doc", 4, 5.195), ("doc", 8, 3.137),
]


@pytest.fixture(scope="module")
def scores(spark):
    rows = [
        (name, criterion, score)
        for criterion, line in MATRIX.items()
        for name, score in zip("ABCDE", line, strict=True)
    ]
    return local_table(spark, rows, "alternative string, criterion string, score int")


def test_weighted_scores_and_ranking(spark, scores):
    weights = scoring.weight_table(spark, WEIGHTS)
    ranked = scoring.rank_scores(scoring.weighted_scores(scores, weights)).orderBy("rank").collect()
    assert {r.alternative: round(r.total, 2) for r in ranked} == {
        "A": 2.82, "B": 3.32, "C": 3.10, "D": 3.08, "E": 3.36,
    }
    assert [r.alternative for r in ranked] == ["E", "B", "C", "D", "A"]


def test_cost_weight_flips_the_ranking(spark, scores):
    shifts = {"base": {}, "plus": {"costo": 5}, "minus": {"costo": -5}}
    ranking = scoring.sensitivity(scores, scoring.scenario_table(spark, WEIGHTS, shifts))
    first = {r.scenario: (r.alternative, round(r.total, 3)) for r in ranking.where("rank = 1").collect()}
    assert first == {"base": ("E", 3.36), "plus": ("B", 3.352), "minus": ("E", 3.484)}


def test_score_matrix(spark, scores):
    table = scoring.score_matrix(scores, scoring.weight_table(spark, WEIGHTS), list("ABCDE"))
    rows = {r.criterion: r for r in table.collect()}
    assert len(rows) == 11 and rows["costo"].weight_pct == 15.0 and rows["costo"].A == 5.0
    assert (rows["TOTAL"].A, rows["TOTAL"].E, rows["TOTAL"].weight_pct) == (2.82, 3.36, 100.0)


def run_log(spark, rows):
    return local_table(spark, rows, "job string, p int, seconds double")


def test_scaling_report(spark):
    rows = {r.p: r for r in scaling.scaling_report(run_log(spark, RUNS)).collect()}
    assert rows[1].median_seconds == pytest.approx(18.3104)
    assert [round(rows[p].speedup, 3) for p in (2, 4, 8)] == [1.868, 3.525, 5.837]
    assert rows[8].efficiency == pytest.approx(rows[8].speedup / 8)


def test_serial_fraction(spark):
    exact = [("half", p, 0.5 + 0.5 / p) for p in (1, 2, 4, 8)]
    single = [("one", 1, 10.0), ("one", 2, 6.0)]
    alone = [("no base", 2, 6.0)]
    super_linear = [("super", 1, 10.0), ("super", 2, 4.0), ("super", 4, 2.0)]
    log = run_log(spark, RUNS + exact + single + alone + super_linear)
    fit = {r.job: r for r in scaling.scaling_verdict(scaling.amdahl_fit(log), 8).collect()}
    assert set(fit) == {"doc", "half", "one", "super"}
    assert fit["doc"].serial_fraction == pytest.approx(0.0523, abs=1e-4)
    assert fit["doc"].r2 == pytest.approx(0.9993, abs=1e-4)
    assert fit["doc"].verdict == "moderate serial share"
    assert fit["half"].serial_fraction == pytest.approx(0.5)
    assert fit["half"].max_speedup == pytest.approx(2.0)
    assert fit["half"].predicted_speedup == pytest.approx(1 / (0.5 + 0.5 / 8))
    assert fit["one"].r2 == 1.0 and fit["one"].points == 1
    assert fit["super"].serial_fraction == 0.0 and fit["super"].max_speedup == float("inf")


def test_serial_fraction_is_the_least_squares_optimum(spark):
    fit = scaling.amdahl_fit(run_log(spark, RUNS)).first()
    s = {2: 18.3104 / 9.804, 4: 18.3104 / 5.195, 8: 18.3104 / 3.137}

    def loss(f):
        return sum((v - 1 / (f + (1 - f) / p)) ** 2 for p, v in s.items())

    best = min((loss(k / 100_000), k / 100_000) for k in range(1, 30_000))[1]
    assert fit.serial_fraction == pytest.approx(best, abs=2e-5)


def test_kernel_equals_batch_version(spark):
    base = spark.range(0, 500, 1, 3).select((F.col("id") / 7.0).alias("x"))
    both = trig_kernel_arrow(base, "x", "b").withColumn("a", trig_kernel(F.col("x")))
    assert both.where(F.abs(F.col("a") - F.col("b")) > 1e-9).count() == 0


def test_scalar_functions(spark):
    row = local_table(spark, [(0.125, 2.675, "2024-01-07", "2024-01-01")],
                      "a double, b double, s string, m string").select(
        S.cents(F.col("a")).alias("a"), S.cents(F.col("b")).alias("b"),
        S.weekday_name(F.col("s").cast("date")).alias("sun"),
        S.weekday_number(F.col("s").cast("date")).alias("sun_no"),
        S.weekday_name(F.col("m").cast("date")).alias("mon"),
        S.weekday_number(F.col("m").cast("date")).alias("mon_no"),
        S.period_label(F.lit(2024), F.lit(3)).alias("period"),
        S.month_key(F.col("s").cast("date")).alias("month"),
        S.percent(F.lit(1), F.lit(0)).alias("nothing"),
        S.labelled_id("TXN-", F.lit(1234567), 6).alias("wide"),
        S.thousands(F.lit(2500.0)).alias("k"),
    ).first()
    assert (row.a, row.b) == (0.13, 2.68)
    assert (row.sun, row.sun_no, row.mon, row.mon_no) == ("Sunday   ", 0, "Monday   ", 1)
    assert (row.period, row.month, row.nothing, row.wide, row.k) == (
        "2024-03", "2024-01", None, "TXN-1234567", 2.5,
    )


def test_money_sums_handle_signs_and_nulls(spark):
    values = [0.1] * 10 + [-0.3, None, float("nan"), -1234567.891, 1e11]
    rows = local_table(spark, [(v,) for v in values], "v double")
    row = rows.agg(
        S.money_sum(F.col("v")).alias("s"), S.money_mean(F.col("v")).alias("m"),
        S.money_sum(F.when(F.col("v") > 1e12, F.col("v"))).alias("none"),
    ).first()
    assert row.s == 99998765432.809 and row.none is None
    assert row.m == row.s / 13


def test_funnel_is_open_and_keeps_empty_steps(spark):
    events = local_table(
        spark, [("s1", "page_view"), ("s2", "click"), ("s3", "click"), ("s3", "click"), (None, "click")],
        "session_id string, event_type string",
    )
    rows = gold.funnel(events, ["page_view", "click", "search", "purchase"]).collect()
    assert [r.paso for r in rows] == ["page_view", "click", "search", "purchase"]
    assert [r.sesiones for r in rows] == [1, 2, 0, 0]
    assert [r.tasa_conversion_paso for r in rows] == [None, 200.0, 0.0, None]
    assert rows[1].pct_del_total == 66.67
    empty = gold.funnel(events.where("false"), ["page_view"]).first()
    assert (empty.sesiones, empty.pct_del_total) == (0, 0.0)


def test_profile_without_events_and_null_groups(spark):
    txn = local_table(
        spark, [("1", "U1", "a", 10.0), ("2", "U1", None, 20.5), ("3", None, "a", 5.0)],
        "transaction_id string, user_id string, category string, amount double",
    ).withColumn("date", F.lit("2024-01-01").cast("timestamp_ntz"))
    evt = local_table(
        spark, [("e", "U9", "s", 1.0)],
        "event_id string, user_id string, session_id string, duration_sec double",
    )
    rows = gold.perfil_usuarios(txn, evt).collect()
    assert len(rows) == 1
    assert (rows[0].gasto_total, rows[0].categorias_unicas, rows[0].num_eventos) == (30.5, 1, None)
    types = dict(gold.perfil_usuarios(txn, evt).dtypes)
    assert types["num_eventos"] == "bigint" and types["sesiones_unicas"] == "bigint"


def test_device_report_keeps_null_groups_and_counts_null_sessions(spark):
    events = local_table(
        spark,
        [("m", "c", "s1", "purchase", 2.0), ("m", "c", None, "click", 4.0), (None, "c", "s1", "click", 1.0)],
        "device string, browser string, session_id string, event_type string, duration_sec double",
    )
    rows = {r.device: r for r in analytics.comportamiento_dispositivos(events).collect()}
    assert (rows["m"].num_sesiones, rows["m"].sesiones_unicas, rows["m"].num_compras) == (1, 2, 1)
    assert rows["m"].dur_media_seg == 3.0 and None in rows


def test_rfm_bands(spark):
    rows = local_table(spark, [(t,) for t in (3, 5, 6, 8, 9, 11, 12, 15)], "t int")
    names = [r.s for r in rows.select(analytics.segment(F.col("t")).alias("s")).collect()]
    assert names == ["En Riesgo"] * 2 + ["Potencial"] * 2 + ["Leal"] * 2 + ["Campeón"] * 2


def test_rfm_ties_follow_spend_then_user(spark):
    rows = [(f"U{i}", 3, float(100 - i)) for i in range(5)]
    profile = local_table(spark, rows, "user_id string, num_compras long, gasto_total double")
    profile = profile.withColumn("ultima_compra", F.lit("2024-05-05").cast("timestamp_ntz"))
    scored = {r.user_id: r for r in analytics.rfm_scores(profile).collect()}
    assert [scored[f"U{i}"].F_score for i in range(5)] == [1, 2, 3, 4, 5]
    assert [scored[f"U{i}"].M_score for i in range(5)] == [5, 4, 3, 2, 1]


def test_pivot_gap_and_total(spark):
    facts = local_table(
        spark, [("N", "x", 1.0), ("N", "x", 2.0), ("S", "y", 5.0)], "region string, canal string, total double"
    )
    rows = {r.region: r for r in sales.region_por_canal(facts, ["x", "y"]).collect()}
    assert (rows["N"].x, rows["N"].y, rows["N"].TOTAL) == (3.0, 0.0, 3.0)
    assert (rows["S"].x, rows["S"].TOTAL) == (0.0, 5.0)


def test_preview(spark):
    wide = spark.range(20).select(*[F.col("id").alias(f"c{i}") for i in range(12)])
    small = aggregates.preview(wide)
    assert small.count() == 5 and len(small.columns) == 8


def test_sales_reports_agree_with_each_other(spark):
    fact, products = synthetic_sales(spark, 2000), product_dimension(spark)
    whole = sales.resumen_general(fact).first()
    assert whole.total_transacciones == 2000
    by_category = sales.ventas_por_categoria(fact, products).collect()
    assert sum(r.num_ventas for r in by_category) == 2000
    assert sum(r.unidades for r in by_category) == whole.unidades_totales
    assert abs(sum(r.pct_ingresos for r in by_category) - 100) < 0.5
    assert len(sales.top_productos(fact, products).collect()) == 5
    daily = sales.reporte_diario(fact, products)
    total = daily.agg(F.sum("num_ventas"), F.sum("ingresos_totales")).first()
    assert total[0] == 2000 and total[1] == pytest.approx(whole.ingresos_totales, abs=1)
    sales.register_daily_view(fact, products)
    assert spark.sql("SELECT * FROM reporte_diario LIMIT 10").count() == 10
    sample = sales.muestra(fact, products).collect()
    assert len(sample) == 500
    assert [(r.fecha, r.id) for r in sample] == sorted((r.fecha, r.id) for r in sample)
    assert len(sales.full_report(fact, products, ["online", "tienda", "b2b"])) == 8


def test_star_load_is_idempotent(spark, tmp_path):
    first = write_star(spark, str(tmp_path), 300)
    again = write_star(spark, str(tmp_path), 900)
    assert first["transacciones"].count() == again["transacciones"].count() == 300
    assert again["productos"].count() == 15
    orphans = again["transacciones"].join(
        again["productos"].select(F.col("id").alias("producto_id")), "producto_id", "left_anti"
    )
    assert orphans.count() == 0


def test_pivot_keeps_values_outside_the_list(spark):
    from mercadal.operators.aggregates import pivot_sum

    rows = [("r", "x", 1.0), ("r", "new", 100.0), ("r", None, 5.0), (None, "x", 2.0)]
    cells = local_table(spark, rows, "row string, col string, v double")
    table = pivot_sum(cells, "row", "col", ["x", "absent"], "v", total="TOTAL")
    assert table.columns == ["row", "x", "absent", "new", "TOTAL"]
    got = {r.row: tuple(r)[1:] for r in table.collect()}
    assert got == {"r": (1.0, 0.0, 100.0, 101.0), None: (2.0, 0.0, 0.0, 2.0)}


def test_numbers_in_other_notations_are_not_numbers(spark):
    from mercadal.functions.scalars import lenient_number

    texts = ["1.5d", "1.5f", "0x1p3", "1e3", " -2.5 ", ".5", "5.", "", "NaN", "Infinity", None]
    frame = local_table(spark, [(t,) for t in texts], "t string")
    got = [r.n for r in frame.select(lenient_number(F.col("t")).alias("n")).collect()]
    assert got == [None, None, None, 1000.0, -2.5, 0.5, 5.0, None, None, None, None]


def test_catalog_follows_the_rules(spark):
    from mercadal.plans import governance
    from mercadal.schemas import event_rules, transaction_rules

    ids = {r.id for r in governance.rule_catalog(spark).collect()}
    assert ids == {r.id for r in [*transaction_rules(), *event_rules()]}
    fields = {(r.dataset, r.campo): r for r in governance.field_catalog(spark).collect()}
    assert fields["transacciones", "category"].reglas == ["R04a"]
    assert fields["transacciones", "transaction_id"].clave_primaria
    assert not fields["eventos", "page"].obligatorio


def test_sample_chooses_its_rows_before_it_joins(spark):
    lines = local_table(
        spark, [(i, 1, i % 3, 2, f"2024-01-{1 + i % 5:02d}", float(i)) for i in range(40)],
        "id long, linea int, producto_id long, cantidad int, fecha string, total double",
    )
    products = local_table(spark, [(i, f"p{i}", "c") for i in range(3)], "id long, nombre string, categoria string")
    places = local_table(spark, [(i, "r", "web") for i in range(40)], "id long, region string, canal string")
    got = sales.muestra_con_lugar(lines, products, places, 7)
    assert got.columns == sales.SAMPLE_FIELDS
    want = sorted(((f"2024-01-{1 + i % 5:02d}", i) for i in range(40)))[:7]
    assert [(r.fecha, r.id, r.nombre, r.total) for r in got.collect()] == [(d, i, f"p{i % 3}", float(i)) for d, i in want]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("GlobalLimit 7") == 1 and plan.index("GlobalLimit 7") > plan.index("Join")
