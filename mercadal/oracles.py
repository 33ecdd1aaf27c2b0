"""ANSI-style SQL for the same results, written independently of the Spark plans."""

from __future__ import annotations


# table, column, type, required, key of every given table
FIELDS = [
    ("region", "r_regionkey", "int", True, True),
    ("region", "r_name", "string", True, False),
    ("nation", "n_nationkey", "int", True, True),
    ("nation", "n_name", "string", True, False),
    ("nation", "n_regionkey", "int", True, False),
    ("customer", "c_custkey", "bigint", True, True),
    ("customer", "c_name", "string", False, False),
    ("customer", "c_nationkey", "int", True, False),
    ("customer", "c_acctbal", "double", False, False),
    ("customer", "c_mktsegment", "string", False, False),
    ("supplier", "s_suppkey", "bigint", True, True),
    ("supplier", "s_name", "string", False, False),
    ("supplier", "s_nationkey", "int", True, False),
    ("supplier", "s_acctbal", "double", False, False),
    ("part", "p_partkey", "bigint", True, True),
    ("part", "p_name", "string", False, False),
    ("part", "p_brand", "string", False, False),
    ("part", "p_type", "string", False, False),
    ("part", "p_size", "int", False, False),
    ("part", "p_retailprice", "double", True, False),
    ("orders", "o_orderkey", "bigint", True, True),
    ("orders", "o_custkey", "bigint", True, False),
    ("orders", "o_orderstatus", "string", False, False),
    ("orders", "o_totalprice", "double", True, False),
    ("orders", "o_orderdate", "timestamp_ntz", True, False),
    ("orders", "o_orderpriority", "string", False, False),
    ("lineitem", "l_orderkey", "bigint", True, False),
    ("lineitem", "l_partkey", "bigint", True, False),
    ("lineitem", "l_suppkey", "bigint", False, False),
    ("lineitem", "l_linenumber", "int", True, False),
    ("lineitem", "l_quantity", "double", True, False),
    ("lineitem", "l_extendedprice", "double", True, False),
    ("lineitem", "l_discount", "double", False, False),
    ("lineitem", "l_tax", "double", False, False),
    ("lineitem", "l_returnflag", "string", False, False),
    ("lineitem", "l_linestatus", "string", False, False),
    ("lineitem", "l_shipdate", "timestamp_ntz", False, False),
    ("events", "event_id", "bigint", True, True),
    ("events", "ts", "timestamp_ntz", True, False),
    ("events", "user_id", "bigint", True, False),
    ("events", "event_type", "string", True, False),
    ("events", "value", "double", False, False),
    ("events", "props", "string", False, False),
    ("documents", "doc_id", "bigint", True, True),
    ("documents", "text", "string", False, False),
    ("documents", "lang", "string", False, False),
    ("documents", "source", "string", False, False),
    ("documents", "n_chars", "bigint", False, False),
    ("embeddings", "vec_id", "bigint", True, True),
    ("embeddings", "embedding", "array<float>", False, False),
    ("embeddings", "label", "int", False, False),
    ("pages", "page_id", "bigint", True, True),
    ("pages", "url", "string", False, False),
    ("pages", "html", "string", False, False),
    ("benchmark", "item_id", "bigint", True, True),
    ("benchmark", "text", "string", False, False),
    ("labels", "doc_id", "bigint", True, True),
    ("labels", "quality", "int", False, False),
    ("labels", "toxic", "int", False, False),
    ("conversations", "conv_id", "bigint", True, False),
    ("conversations", "turn", "bigint", True, False),
    ("conversations", "role", "string", False, False),
    ("conversations", "text", "string", False, False),
]


def r(expr: str, digits: int) -> str:
    """Half-up rounding of the number as it is written, not of the binary one."""
    return f"CAST(ROUND(CAST(CAST(CAST({expr} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def xsum(expr: str) -> str:
    return f"CAST(SUM(CAST({expr} AS DECIMAL(24,6))) AS DOUBLE)"


def xmean(expr: str) -> str:
    return f"({xsum(expr)} / COUNT({expr}))"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


LINE_TOTAL = (
    "CAST(ROUND(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2)"
    " AS DECIMAL(12,2))"
)
SESSION = "CAST(user_id AS VARCHAR) || '#' || CAST(CAST(ts AS DATE) AS VARCHAR)"
QUINTILE = "CAST(GREATEST(1, CEIL(5.0 * (rk - 1) / NULLIF(n - 1, 0))) AS INTEGER)"


def line_cells(country: str) -> str:
    return f"""cells AS (
        SELECT p_type AS category, CAST(year(o_orderdate) AS INTEGER) AS year,
               CAST(month(o_orderdate) AS INTEGER) AS month, {country} AS country,
               {r(xsum(LINE_TOTAL), 2)} AS total_ingresos,
               {big('SUM(CAST(l_quantity AS INTEGER))')} AS total_unidades,
               COUNT(l_orderkey) AS num_transacciones,
               {r(xmean(LINE_TOTAL), 2)} AS ticket_promedio
        FROM lineitem JOIN part ON l_partkey = p_partkey
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        GROUP BY 1, 2, 3, 4)"""


ORDER_CELLS = f"""cells AS (
        SELECT o_orderpriority AS category, CAST(year(o_orderdate) AS INTEGER) AS year,
               CAST(month(o_orderdate) AS INTEGER) AS month, n_name AS country,
               {r(xsum('o_totalprice'), 2)} AS total_ingresos,
               COUNT(o_orderkey) AS num_transacciones,
               {r(xmean('o_totalprice'), 2)} AS ticket_promedio
        FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        GROUP BY 1, 2, 3, 4)"""

SERIES = f"""{ORDER_CELLS},
    months AS (
        SELECT year, month, {xsum('total_ingresos')} AS ingresos_mes,
               {big('SUM(num_transacciones)')} AS transacciones_mes
        FROM cells GROUP BY year, month)"""

BUYERS = f"""buyers AS (
        SELECT o_custkey AS user_id, COUNT(o_orderkey) AS num_compras,
               {r(xsum('o_totalprice'), 2)} AS gasto_total,
               {r(xmean('o_totalprice'), 2)} AS gasto_promedio,
               COUNT(DISTINCT o_orderpriority) AS categorias_unicas,
               MIN(o_orderdate) AS primera_compra, MAX(o_orderdate) AS ultima_compra
        FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1)"""


def _score(value: str, name: str) -> str:
    rank = f"ROW_NUMBER() OVER (ORDER BY {value}, gasto_total DESC, user_id)"
    return (
        f"CAST(GREATEST(1, CEIL(5.0 * ({rank} - 1) / NULLIF(COUNT(*) OVER () - 1, 0))) AS INTEGER)"
        f" AS {name}"
    )


RFM = f"""{BUYERS},
    scored AS (
        SELECT user_id, ultima_compra, num_compras, gasto_total,
               {_score('ultima_compra', 'R_score')}, {_score('num_compras', 'F_score')},
               {_score('gasto_total', 'M_score')}
        FROM buyers),
    rfm AS (
        SELECT *, R_score + F_score + M_score AS RFM_total,
               CASE WHEN R_score + F_score + M_score >= 12 THEN 'Campeón'
                    WHEN R_score + F_score + M_score >= 9 THEN 'Leal'
                    WHEN R_score + F_score + M_score >= 6 THEN 'Potencial'
                    ELSE 'En Riesgo' END AS segmento
        FROM scored)"""

EVENT_FLAGS = """judged AS (
        SELECT e.*,
               (event_id IS NULL OR user_id IS NULL OR event_type IS NULL OR ts IS NULL) AS f1,
               (ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY event_id) > 1) AS f2,
               COALESCE(value <= 1, FALSE) AS f3,
               COALESCE(event_type NOT IN ('view', 'click', 'signup', 'purchase'), FALSE) AS f4,
               COALESCE(ts > TIMESTAMP '2024-01-25 00:00:00', FALSE) AS f5,
               (user_id IS NOT NULL AND NOT EXISTS (
                    SELECT 1 FROM customer WHERE c_custkey = e.user_id AND c_acctbal > 0)) AS f6,
               NOT COALESCE(regexp_full_match(props, '\\{"k": [0-9]{2}\\}'), FALSE) AS f7
        FROM events e),
    quart AS (
        SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events),
    lim AS (SELECT q3 + 3 * (q3 - q1) AS threshold FROM quart),
    flagged AS (
        SELECT judged.*, COALESCE(value > threshold, FALSE) AS f8,
               (f1 OR f2 OR f3 OR f4 OR f5 OR f6 OR f7) AS bad
        FROM judged CROSS JOIN lim)"""



def hit(key: str, every: int, at: int) -> str:
    """Whether a planted fault of these numbers takes the row with this key."""
    return f"(COALESCE({key}, 0) % 2147483647 * 48271 % 2147483647 % {every} = {at})"


FAULTY_EVENTS = f"""faulty AS (
        SELECT event_id,
               CASE WHEN {hit('event_id', 71, 13)} THEN TIMESTAMP '2030-01-01 00:00:00' ELSE ts END AS ts,
               CASE WHEN {hit('event_id', 73, 17)} THEN -9 ELSE user_id END AS user_id,
               CASE WHEN {hit('event_id', 67, 11)} THEN 'teleport'
                    WHEN {hit('event_id', 53, 5)} THEN NULL ELSE event_type END AS event_type,
               CASE WHEN {hit('event_id', 83, 23)} THEN 1e9
                    WHEN {hit('event_id', 61, 7)} THEN -3.5 ELSE value END AS value,
               CASE WHEN {hit('event_id', 79, 19)} THEN '{{}}' ELSE props END AS props,
               CAST(c AS INTEGER) AS copy
        FROM events CROSS JOIN range(3) AS t(c)
        WHERE c = 0 OR {hit('event_id', 89, 29)})"""
FAULTY_FLAGS = EVENT_FLAGS.replace("FROM events", "FROM faulty").replace("ORDER BY event_id", "ORDER BY copy")
PRODUCT_CONSTRAINTS = [
    ("NN", "nn", "'null in product'", "drop"),
    ("PK", "pk", "'repeated product id'", "drop"),
    ("CK", "ck", "'price not above zero'", "drop"),
]
SALE_CONSTRAINTS = [
    ("NN", "nn", "'null in sale'", "drop"),
    ("PK", "pk", "'repeated sale id'", "drop"),
    ("FK", "fk", "'sale of an unknown product'", "drop"),
    ("CK", "ck", "'quantity not above zero'", "drop"),
]

LINE_FLAGS = """placed AS (SELECT *, ROW_NUMBER() OVER () AS place FROM lineitem),
    quart AS (
        SELECT quantile_cont(l_extendedprice, 0.25) AS q1,
               quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem),
    lim AS (SELECT q3 + 0.4 * (q3 - q1) AS threshold FROM quart),
    flagged AS (
        SELECT placed.*, (l_orderkey IS NULL OR l_linenumber IS NULL OR l_extendedprice IS NULL) AS f1,
               (ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY place) > 1) AS f2,
               COALESCE(l_quantity < 5, FALSE) AS f3,
               COALESCE(l_returnflag NOT IN ('A', 'N'), FALSE) AS f4,
               COALESCE(l_shipdate > TIMESTAMP '2001-01-01 00:00:00', FALSE) AS f5,
               (l_suppkey IS NOT NULL AND NOT EXISTS (
                    SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey AND s_acctbal > 0)) AS f6,
               COALESCE(l_extendedprice > threshold, FALSE) AS f8
        FROM placed CROSS JOIN lim)"""


def _report(rules: list[tuple[str, str, str, str]]) -> str:
    """UNION of one counting query per rule: (id, flag, description SQL, action)."""
    parts = [
        f"SELECT '{id_}' AS rule, {text} AS description, COUNT(*) FILTER (WHERE {flag}) AS violations,"
        f" {r(f'100.0 * COUNT(*) FILTER (WHERE {flag}) / GREATEST(COUNT(*), 1)', 2)} AS pct,"
        f" '{action}' AS action FROM flagged"
        for id_, flag, text, action in rules
    ]
    return "\nUNION ALL ".join(parts)


EVENT_RULES = [
    ("R01", "f1", "'required field is null'", "drop"),
    ("R02", "f2", "'repeated event_id'", "drop"),
    ("R03", "f3", "'value not above one'", "drop"),
    ("R04", "f4", "'event_type outside the vocabulary'", "drop"),
    ("R05", "f5", "'ts after the reference instant'", "drop"),
    ("R06", "f6", "'user without positive balance'", "drop"),
    ("R07", "f7", "'props not a two-digit k'", "drop"),
    ("R08", "f8",
     "'value above Q3 + 3 IQR' || printf(' (> %.2f)', (SELECT threshold FROM lim))", "report"),
]
LINE_RULES = [
    ("R01", "f1", "'required field is null'", "drop"),
    ("R02", "f2", "'repeated order line'", "drop"),
    ("R03", "f3", "'quantity below five'", "drop"),
    ("R04", "f4", "'returnflag outside the vocabulary'", "drop"),
    ("R05", "f5", "'shipped after the reference instant'", "drop"),
    ("R06", "f6", "'unknown supplier'", "drop"),
    ("R08", "f8",
     "'price above Q3 + 0.4 IQR' || printf(' (> %.2f)', (SELECT threshold FROM lim))", "report"),
]

FEED_TOTALS = """
    SELECT event_type, COUNT(*) AS n, CAST(SUM(event_id) AS BIGINT) AS id_sum,
           CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total,
           MAX(date_trunc('second', ts)) AS last_ts,
           CAST(SUM(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_sum
    FROM events GROUP BY event_type"""

LINE_SALES = f"""t AS (
        SELECT l_orderkey AS id, l_partkey AS producto_id, CAST(l_quantity AS INTEGER) AS cantidad,
               CAST(l_shipdate AS DATE) AS fecha, {LINE_TOTAL} AS total
        FROM lineitem)"""
ORDER_SALES = """t AS (
        SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS fecha, r_name AS region,
               o_orderpriority AS canal, CAST(o_totalprice AS DECIMAL(12,2)) AS total
        FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
MONEY0 = "CAST(ROUND(SUM(total), 0) AS DOUBLE)"
TICKET0 = r("CAST(SUM(total) AS DOUBLE) / COUNT(total)", 0)
CHANNELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
REGION_NAMES = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]

PLACED_SALES = f"""t AS (
        SELECT l_partkey AS producto_id, CAST(o_orderdate AS DATE) AS fecha, r_name AS region,
               o_orderpriority AS canal, CAST(l_quantity AS INTEGER) AS cantidad, {LINE_TOTAL} AS total
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
REVENUE = f"{MONEY0} AS ingresos"
TICKET = f"{TICKET0} AS ticket_promedio"
# title, label of a row, fields, rows
REPORT = [
    ("Resumen General", "''",
     ["total_transacciones", "unidades_totales", "ingresos_totales", "ticket_promedio", "primera_venta", "ultima_venta"],
     f"""SELECT COUNT(*) AS total_transacciones, SUM(cantidad) AS unidades_totales, {MONEY0} AS ingresos_totales,
         {TICKET}, MIN(fecha) AS primera_venta, MAX(fecha) AS ultima_venta FROM t"""),
    ("Ingresos por Categoría", "categoria", ["num_ventas", "unidades", "ingresos", "pct_ingresos"],
     f"""SELECT p_type AS categoria, COUNT(*) AS num_ventas, SUM(cantidad) AS unidades, {REVENUE},
         {r('100.0 * SUM(total) / SUM(SUM(total)) OVER ()', 1)} AS pct_ingresos
         FROM t JOIN part ON producto_id = p_partkey GROUP BY p_type"""),
    ("Ventas por Región", "region", ["num_ventas", "ingresos", "ticket_promedio"],
     f"SELECT region, COUNT(*) AS num_ventas, {REVENUE}, {TICKET} FROM t GROUP BY region"),
    ("Distribución por Canal", "canal", ["num_ventas", "ingresos", "pct_ventas"],
     f"""SELECT canal, COUNT(*) AS num_ventas, {REVENUE},
         {r('100.0 * COUNT(*) / SUM(COUNT(*)) OVER ()', 1)} AS pct_ventas FROM t GROUP BY canal"""),
    ("Top 5 Productos", "nombre || '/' || categoria", ["num_ventas", "unidades", "ingresos"],
     f"""SELECT p_name AS nombre, p_type AS categoria, COUNT(*) AS num_ventas, SUM(cantidad) AS unidades, {REVENUE}
         FROM t JOIN part ON producto_id = p_partkey GROUP BY ALL ORDER BY ingresos DESC, nombre, categoria LIMIT 5"""),
    ("Tendencia Mensual", "mes", ["num_ventas", "ingresos"],
     f"SELECT strftime(fecha, '%Y-%m') AS mes, COUNT(*) AS num_ventas, {REVENUE} FROM t GROUP BY 1"),
    ("Ventas por Día de Semana", "dia_semana", ["dow", "num_ventas", "ticket_promedio"],
     f"""SELECT rpad(dayname(fecha), 9, ' ') AS dia_semana, dayofweek(fecha) AS dow, COUNT(*) AS num_ventas, {TICKET}
         FROM t GROUP BY 1, 2"""),
    ("Región × Canal", "region", [*[f'"{c}"' for c in CHANNELS], '"TOTAL"'],
     "SELECT region, " + ", ".join(
         f"COALESCE(SUM(v) FILTER (WHERE canal = '{c}'), 0) AS \"{c}\"" for c in CHANNELS
     ) + ', SUM(v) AS "TOTAL" FROM (SELECT region, canal, ROUND(SUM(total), 0) AS v FROM t GROUP BY 1, 2) GROUP BY region'),
]


def report_contents() -> str:
    tables = ", ".join(f"s{i} AS ({rows})" for i, (_, _, _, rows) in enumerate(REPORT, start=1))
    cells = " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS section_no, '{title}' AS title, {label} AS fila,"
        f" '{field.strip(chr(34))}' AS campo,"
        f" CASE WHEN TRY_CAST(CAST({field} AS VARCHAR) AS DOUBLE) IS NULL THEN CAST({field} AS VARCHAR) END AS texto,"
        f" TRY_CAST(CAST({field} AS VARCHAR) AS DOUBLE) AS valor FROM s{i}"
        for i, (title, label, fields, _) in enumerate(REPORT, start=1)
        for field in fields
    )
    return f"WITH {PLACED_SALES}, {tables} {cells}"


CRITERIA = {
    "ingresos": "SUM(CAST(l_extendedprice AS DECIMAL(12,2)))",
    "unidades": "SUM(CAST(l_quantity AS DECIMAL(12,2)))",
    "lineas": "COUNT(*)",
    "descuento": "-SUM(CAST(l_discount AS DECIMAL(12,2)))",
}


def scored(alternative: str, source: str) -> str:
    stacked = " UNION ALL ".join(
        f"SELECT {alternative} AS alternative, '{name}' AS criterion,"
        f" CAST({agg} AS DECIMAL(22,2)) AS value FROM {source} GROUP BY 1"
        for name, agg in CRITERIA.items()
    )
    return f"""stacked AS ({stacked}),
    ranked AS (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY criterion ORDER BY value, alternative) AS rk,
               COUNT(*) OVER (PARTITION BY criterion) AS n FROM stacked),
    scores AS (SELECT alternative, criterion, {QUINTILE} AS score FROM ranked)"""


WEIGHTS = {"ingresos": 40, "unidades": 25, "lineas": 20, "descuento": 15}


def weights_cte(shifts: dict[str, int]) -> str:
    rows = ", ".join(
        f"('{scenario}', '{name}', {w + (shift if name == 'descuento' else 0)}::DOUBLE)"
        for scenario, shift in shifts.items()
        for name, w in WEIGHTS.items()
    )
    return f"""weights(scenario, criterion, weight) AS (VALUES {rows}),
    shares AS (
        SELECT scenario, criterion, weight / SUM(weight) OVER (PARTITION BY scenario) AS share
        FROM weights),
    totals AS (
        SELECT scenario, alternative,
               {r('SUM(CAST(score * share AS DECIMAL(38,12)))', 6)} AS total
        FROM scores JOIN shares USING (criterion) GROUP BY scenario, alternative)"""


RANK = "ROW_NUMBER() OVER (PARTITION BY scenario ORDER BY total DESC, alternative)"

RUN_LOG = """medians AS (
        SELECT l_returnflag || l_linestatus AS job, l_linenumber AS p,
               quantile_cont(l_extendedprice * (0.05::DOUBLE + 0.95::DOUBLE / l_linenumber), 0.5)
                   AS tp
        FROM lineitem GROUP BY 1, 2),
    report AS (
        SELECT m.job, m.p, m.tp, b.tp / NULLIF(m.tp, 0) AS s
        FROM medians m LEFT JOIN medians b ON b.job = m.job AND b.p = 1)"""

MODEL = "(1.0 / (f + (1.0 - f) / x.p))"
SLOPE = f"(-{MODEL} * {MODEL} * (1.0 - 1.0 / x.p))"
FIT = f"""RECURSIVE {RUN_LOG},
    pts AS (SELECT job, CAST(p AS DOUBLE) AS p, s FROM report WHERE p <> 1 AND s IS NOT NULL),
    start AS (
        SELECT job, LEAST(1.0, GREATEST(0.0,
                   SUM((1.0 / s - 1.0 / p) * (1.0 - 1.0 / p)) / SUM((1.0 - 1.0 / p) ** 2))) AS f0
        FROM pts GROUP BY job),
    lists AS (
        SELECT job, f0, list({{'p': p, 's': s}} ORDER BY p) AS l
        FROM pts JOIN start USING (job) GROUP BY job, f0),
    it(k, job, f, l) AS (
        SELECT 0, job, CAST(f0 AS DOUBLE), l FROM lists
        UNION ALL
        SELECT k + 1, job, LEAST(1.0, GREATEST(0.0, f +
                   list_sum(list_transform(l, lambda x: {SLOPE} * (x.s - {MODEL})))
                   / list_sum(list_transform(l, lambda x: {SLOPE} * {SLOPE})))), l
        FROM it WHERE k < 24),
    fit AS (
        SELECT it.job, it.f, it.l, f0, list_avg(list_transform(it.l, lambda x: x.s)) AS m
        FROM it JOIN lists USING (job) WHERE k = 24),
    judged AS (
        SELECT *, 1.0 - list_sum(list_transform(l, lambda x: (x.s - {MODEL}) ** 2))
                      / list_sum(list_transform(l, lambda x: (x.s - m) ** 2)) AS r2 FROM fit)"""

ORACLES: dict[str, str] = {
    "sales_by_category_month": f"WITH {line_cells('n_name')} SELECT * FROM cells",
    "top_categories": f"""WITH {line_cells('n_name')}
        SELECT category, {xsum('total_ingresos')} AS ingresos_totales,
               {big('SUM(total_unidades)')} AS unidades_totales,
               {big('SUM(num_transacciones)')} AS num_transacciones,
               {xmean('ticket_promedio')} AS ticket_promedio,
               COUNT(DISTINCT country) AS num_paises
        FROM cells GROUP BY category ORDER BY ingresos_totales DESC, category LIMIT 10""",
    "country_category_pivot": f"""WITH {line_cells('r_name')}
        SELECT country, {', '.join(
            f"COALESCE(CAST(SUM(CAST(total_ingresos AS DECIMAL(24,6))) FILTER (WHERE category = '{t}')"
            f' AS DOUBLE), 0) AS "{t}"' for t in TYPES)}
        FROM cells GROUP BY country""",
    "monthly_running_total": f"""WITH {SERIES}
        SELECT *, printf('%d-%02d', year, month) AS periodo,
               CAST(SUM(CAST(ingresos_mes AS DECIMAL(38,6))) OVER (ORDER BY year, month
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS ingresos_acum
        FROM months""",
    "monthly_chart": f"""WITH {SERIES}
        SELECT printf('%d-%02d', year, month) AS periodo,
               ingresos_mes / 1000.0 AS ingresos_mes_miles FROM months""",
    "country_share": f"""WITH {ORDER_CELLS}, by_country AS (
            SELECT country, {xsum('total_ingresos')} AS ingresos_totales,
                   {big('SUM(num_transacciones)')} AS num_transacciones,
                   {r(xmean('ticket_promedio'), 2)} AS ticket_promedio
            FROM cells GROUP BY country)
        SELECT *, {r('100.0 * ingresos_totales / SUM(ingresos_totales) OVER ()', 2)}
                   AS pct_ingresos FROM by_country""",
    "user_profile": f"""WITH {BUYERS}, visits AS (
            SELECT user_id, COUNT(event_id) AS num_eventos,
                   COUNT(DISTINCT {SESSION}) AS sesiones_unicas,
                   {r(xmean('value'), 2)} AS dur_media_seg
            FROM events WHERE user_id IS NOT NULL GROUP BY user_id)
        SELECT buyers.*, num_eventos, sesiones_unicas, dur_media_seg
        FROM buyers LEFT JOIN visits USING (user_id)""",
    "conversion_funnel": f"""WITH e AS (SELECT {SESSION} AS s, event_type FROM events),
        steps(i, step) AS (VALUES (0, 'view'), (1, 'click'), (2, 'signup'), (3, 'purchase')),
        counted AS (
            SELECT i, step, COUNT(DISTINCT s) AS n FROM steps LEFT JOIN e ON event_type = step
            GROUP BY i, step),
        full_set AS (SELECT COUNT(DISTINCT s) AS n FROM e)
        SELECT step AS paso, counted.n AS sesiones,
               {r('100.0 * counted.n / GREATEST(full_set.n, 1)', 2)} AS pct_del_total,
               LAG(counted.n) OVER (ORDER BY i) AS sesiones_previas,
               {r('100.0 * counted.n / NULLIF(LAG(counted.n) OVER (ORDER BY i), 0)', 2)}
                   AS tasa_conversion_paso
        FROM counted CROSS JOIN full_set""",
    "behaviour_by_device": f"""
        SELECT event_type, CAST(hour(ts) AS INTEGER) AS hour, COUNT({SESSION}) AS num_sessions,
               COUNT(DISTINCT {SESSION}) AS unique_sessions,
               {r(xmean('value'), 2)} AS mean_duration, MAX(value) AS max_duration,
               COUNT(*) FILTER (WHERE event_type = 'purchase') AS num_purchases
        FROM events GROUP BY 1, 2""",
    "rfm_scores": f"WITH {RFM} SELECT * FROM rfm",
    "rfm_segments": f"""WITH {RFM}
        SELECT segmento, COUNT(user_id) AS num_usuarios,
               {r(xmean('gasto_total'), 2)} AS gasto_medio,
               {r(xmean('num_compras'), 2)} AS compras_medias
        FROM rfm GROUP BY segmento""",
    "segment_counts": f"""WITH {RFM}, sizes AS (
            SELECT segmento, COUNT(*) AS num_usuarios FROM rfm GROUP BY segmento)
        SELECT *, {r('100.0 * num_usuarios / SUM(num_usuarios) OVER ()', 1)} AS pct_usuarios
        FROM sizes""",
    "order_price_rank": """SELECT o_orderkey, o_totalprice,
            ROW_NUMBER() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS price_rank FROM orders""",
    "supplier_balance_quintile": f"""WITH ranked AS (
            SELECT s_suppkey, s_acctbal, ROW_NUMBER() OVER (ORDER BY s_acctbal, s_suppkey) AS rk,
                   COUNT(*) OVER () AS n FROM supplier)
        SELECT s_suppkey, s_acctbal, {QUINTILE} AS score FROM ranked""",
    "dq_report_events": f"WITH {EVENT_FLAGS} {_report(EVENT_RULES)}",
    "dq_clean_events": f"""WITH {EVENT_FLAGS}
        SELECT event_id, ts, user_id, event_type, value, props FROM flagged WHERE NOT bad""",
    "dq_stats": f"""WITH {EVENT_FLAGS}
        SELECT COUNT(*) AS rows_in, COUNT(*) FILTER (WHERE NOT bad) AS rows_out,
               MIN(value) FILTER (WHERE NOT bad) AS min_value,
               MAX(value) FILTER (WHERE NOT bad) AS max_value,
               {r("CAST(SUM(CAST(value AS DECIMAL(24,6))) FILTER (WHERE NOT bad) AS DOUBLE)"
                  " / COUNT(value) FILTER (WHERE NOT bad)", 6)} AS mean_value,
               {r('100.0 * COUNT(*) FILTER (WHERE bad) / GREATEST(COUNT(*), 1)', 2)} AS reject_pct
        FROM flagged""",
    "tiny_sums": """SELECT l_returnflag,
            ROUND(CAST(SUM(CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) / 1e7, 15) AS total, 3 * COUNT(*) AS n
        FROM lineitem GROUP BY l_returnflag""",
    "dq_clean_lineitem": f"""WITH {LINE_FLAGS}
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
               l_tax, l_returnflag, l_linestatus, l_shipdate
        FROM flagged WHERE NOT (f1 OR f2 OR f3 OR f4 OR f5 OR f6)""",
    "dq_report_lineitem": f"WITH {LINE_FLAGS} {_report(LINE_RULES)}",
    "dedup_lineitem_first": """SELECT * EXCLUDE (rn) FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                         l_returnflag, l_linestatus, l_shipdate) AS rn
            FROM lineitem) WHERE rn = 1""",
    "constraint_report": "WITH flagged AS (" + """
            SELECT (l_orderkey IS NULL OR l_linenumber IS NULL OR l_partkey IS NULL
                    OR l_quantity IS NULL OR l_extendedprice IS NULL OR l_discount IS NULL) AS nn,
                   (ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber) > 1) AS pk,
                   (l_partkey IS NOT NULL AND NOT EXISTS (
                        SELECT 1 FROM part WHERE p_partkey = l_partkey
                        AND p_retailprice >= 950)) AS fk,
                   COALESCE(l_quantity <= 2, FALSE) AS ck
            FROM lineitem) """ + _report(
        [
            ("NN", "nn", "'null in sale'", "drop"),
            ("PK", "pk", "'repeated sale id'", "drop"),
            ("FK", "fk", "'sale of an unlisted product'", "drop"),
            ("CK", "ck", "'quantity not above two'", "drop"),
        ]
    ),
    "stamp_layouts": """WITH named(feed, layout) AS (VALUES ('A', 'dd/MM/yyyy HH:mm:ss'),
            ('N', 'yyyy-MM-ddTHH:mm:ss'), ('R', 'MM/dd/yyyy'), ('events', 'yyyy/MM/dd HH:mm:ss')),
        t AS (SELECT l_returnflag AS feed, CASE WHEN l_linenumber < 5 THEN l_shipdate END AS st FROM lineitem
            UNION ALL SELECT 'events', date_trunc('second', ts) FROM events)
        SELECT feed, layout, COUNT(*) AS n_rows, COUNT(st) AS n_stamps, MIN(st) AS first_stamp, MAX(st) AS last_stamp
        FROM t JOIN named USING (feed) GROUP BY feed, layout""",
    "faulty_event_report": f"WITH {FAULTY_EVENTS}, {FAULTY_FLAGS} {_report(EVENT_RULES)}",
    "faulty_event_rows": f"""WITH {FAULTY_EVENTS}, {FAULTY_FLAGS}
        SELECT event_id, ts, user_id, event_type, value, props, copy FROM flagged WHERE NOT bad""",
    "faulty_star_report": f"""SELECT 'productos' AS tabla, * FROM (WITH faulty AS (
            SELECT p_partkey AS id, CASE WHEN NOT {hit('p_partkey', 17, 5)} THEN p_name END AS nombre,
                   p_type AS categoria, CASE WHEN {hit('p_partkey', 23, 11)} THEN -3.5
                        WHEN {hit('p_partkey', 19, 7)} THEN 0 ELSE p_retailprice END AS precio_unitario
            FROM part CROSS JOIN range(4) AS t(c) WHERE c = 0 OR {hit('p_partkey', 29, 13)}),
        flagged AS (
            SELECT (id IS NULL OR nombre IS NULL OR categoria IS NULL OR precio_unitario IS NULL) AS nn,
                   (ROW_NUMBER() OVER (PARTITION BY id) > 1) AS pk, COALESCE(precio_unitario <= 0, FALSE) AS ck
            FROM faulty) {_report(PRODUCT_CONSTRAINTS)})
        UNION ALL SELECT 'ventas' AS tabla, * FROM (WITH sold AS (
            SELECT l_orderkey * 10 + l_linenumber AS id, l_partkey, l_quantity, l_shipdate, l_discount, r_name,
                   o_orderpriority, l_extendedprice
            FROM lineitem LEFT JOIN (orders JOIN customer ON o_custkey = c_custkey
                JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
                ON l_orderkey = o_orderkey),
        faulty AS (
            SELECT id, CASE WHEN {hit('id', 61, 7)} THEN -1 ELSE l_partkey END AS producto_id,
                   CASE WHEN {hit('id', 71, 13)} THEN -4 WHEN {hit('id', 67, 11)} THEN 0 ELSE l_quantity END AS cantidad,
                   ({hit('id', 53, 5)} OR {hit('id', 59, 3)} OR l_shipdate IS NULL OR r_name IS NULL
                    OR o_orderpriority IS NULL OR l_extendedprice * l_discount IS NULL) AS lacks
            FROM sold CROSS JOIN range(2) AS t(c) WHERE c = 0 OR {hit('id', 73, 17)}),
        flagged AS (
            SELECT (id IS NULL OR producto_id IS NULL OR cantidad IS NULL OR lacks) AS nn,
                   (ROW_NUMBER() OVER (PARTITION BY id) > 1) AS pk,
                   (producto_id IS NOT NULL AND producto_id NOT IN (SELECT p_partkey FROM part)) AS fk,
                   COALESCE(cantidad <= 0, FALSE) AS ck
            FROM faulty) {_report(SALE_CONSTRAINTS)})""",
    "fk_orphans": """SELECT * FROM events WHERE user_id IS NOT NULL AND user_id NOT IN (
            SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
    "fk_valid": """SELECT * FROM events WHERE user_id IN (
            SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
    "iqr_outliers": f"""WITH q AS (
            SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
        SELECT event_id, value, {r('q3 + 3 * (q3 - q1)', 4)} AS threshold
        FROM events CROSS JOIN q WHERE value > q3 + 3 * (q3 - q1)""",
    "price_quartiles": f"""SELECT l_returnflag,
            {r('quantile_cont(l_extendedprice, 0.25)', 4)} AS q1,
            {r('quantile_cont(l_extendedprice, 0.5)', 4)} AS q2,
            {r('quantile_cont(l_extendedprice, 0.75)', 4)} AS q3
        FROM lineitem GROUP BY l_returnflag""",
    "lenient_cast": """WITH t AS (
            SELECT l_returnflag,
                   TRY_CAST(CASE WHEN l_returnflag = 'R' THEN l_linenumber || ' uds'
                            ELSE CAST(l_linenumber AS VARCHAR) END AS DOUBLE) AS num,
                   TRY_CAST(printf('%d-%02d-15 00:00:00', year(l_shipdate),
                            CAST(l_quantity AS INTEGER)) AS TIMESTAMP) AS st
            FROM lineitem)
        SELECT l_returnflag, COUNT(*) AS rows, COUNT(num) AS numbers, SUM(num) AS number_sum,
               COUNT(st) AS stamps, MIN(st) AS first_stamp
        FROM t GROUP BY l_returnflag""",
    "sales_summary": f"""WITH {LINE_SALES}
        SELECT COUNT(*) AS total_transacciones, {big('SUM(cantidad)')} AS unidades_totales,
               {MONEY0} AS ingresos_totales, {TICKET0} AS ticket_promedio,
               MIN(fecha) AS primera_venta, MAX(fecha) AS ultima_venta FROM t""",
    "sales_by_part_type": f"""WITH {LINE_SALES}
        SELECT p_type AS categoria, COUNT(*) AS num_ventas, {big('SUM(cantidad)')} AS unidades,
               {MONEY0} AS ingresos,
               {r('100.0 * CAST(SUM(total) AS DOUBLE) / CAST(SUM(SUM(total)) OVER () AS DOUBLE)', 1)}
                   AS pct_ingresos
        FROM t JOIN part ON producto_id = p_partkey GROUP BY p_type""",
    "top5_products": f"""WITH {LINE_SALES}
        SELECT p_name AS nombre, p_type AS categoria, COUNT(*) AS num_ventas,
               {big('SUM(cantidad)')} AS unidades, {MONEY0} AS ingresos
        FROM t JOIN part ON producto_id = p_partkey GROUP BY p_name, p_type
        ORDER BY ingresos DESC, nombre, categoria LIMIT 5""",
    "monthly_trend": f"""WITH {LINE_SALES}
        SELECT strftime(fecha, '%Y-%m') AS mes, COUNT(*) AS num_ventas, {MONEY0} AS ingresos
        FROM t GROUP BY 1""",
    "weekday_sales": f"""WITH {LINE_SALES}
        SELECT rpad(dayname(fecha), 9, ' ') AS dia_semana,
               CAST(dayofweek(fecha) AS INTEGER) AS dow, COUNT(*) AS num_ventas,
               {TICKET0} AS ticket_promedio
        FROM t GROUP BY 1, 2""",
    "sales_by_region": f"""WITH {ORDER_SALES}
        SELECT region, COUNT(*) AS num_ventas, {MONEY0} AS ingresos, {TICKET0} AS ticket_promedio
        FROM t GROUP BY region""",
    "sales_by_channel": f"""WITH {ORDER_SALES}
        SELECT canal, COUNT(*) AS num_ventas, {MONEY0} AS ingresos,
               {r('100.0 * COUNT(*) / SUM(COUNT(*)) OVER ()', 1)} AS pct_ventas
        FROM t GROUP BY canal""",
    "region_channel_pivot": f"""WITH {ORDER_SALES}, c AS (
            SELECT region, canal, ROUND(SUM(total), 0) AS v FROM t GROUP BY region, canal)
        SELECT region, {', '.join(
            f"CAST(COALESCE(SUM(v) FILTER (WHERE canal = '{c}'), 0) AS DOUBLE) AS \"{c}\""
            for c in CHANNELS)}, CAST(SUM(v) AS DOUBLE) AS "TOTAL"
        FROM c GROUP BY region""",
    "daily_report": f"""WITH t AS (
            SELECT CAST(o_orderdate AS DATE) AS fecha, p_type AS categoria, r_name AS region,
                   o_orderpriority AS canal, CAST(l_quantity AS INTEGER) AS cantidad,
                   {LINE_TOTAL} AS total
            FROM lineitem JOIN part ON l_partkey = p_partkey
            JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
            JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
        SELECT fecha, categoria, region, canal, COUNT(*) AS num_ventas,
               {big('SUM(cantidad)')} AS unidades_vendidas,
               CAST(SUM(total) AS DOUBLE) AS ingresos_totales,
               {r('CAST(SUM(total) AS DOUBLE) / COUNT(total)', 2)} AS ticket_promedio
        FROM t GROUP BY 1, 2, 3, 4""",
    "sample_export": f"""WITH {ORDER_SALES}
        SELECT id, fecha, region, canal, CAST(total AS DOUBLE) AS total
        FROM t ORDER BY fecha, id LIMIT 500""",
    "joined_sample_export": f"""WITH t AS (
            SELECT l_orderkey AS id, l_linenumber AS linea, l_partkey AS producto_id,
                   CAST(l_quantity AS INTEGER) AS cantidad, CAST(l_shipdate AS DATE) AS fecha,
                   CAST({LINE_TOTAL} AS DOUBLE) AS total FROM lineitem)
        SELECT id, p_name AS nombre, p_type AS categoria, cantidad, fecha, r_name AS region,
               o_orderpriority AS canal, total
        FROM t JOIN part ON producto_id = p_partkey JOIN orders ON id = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        ORDER BY fecha, id, linea, producto_id, cantidad, total LIMIT 500""",
    "report_sections": f"""WITH {LINE_SALES}, o AS (
            SELECT r_name, o_orderpriority FROM orders JOIN customer ON o_custkey = c_custkey
            JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
        SELECT 1 AS section_no, 'Resumen General' AS title, CAST(1 AS BIGINT) AS lines
        UNION ALL SELECT 2, 'Ingresos por Categoría', COUNT(DISTINCT p_type)
            FROM t JOIN part ON producto_id = p_partkey
        UNION ALL SELECT 3, 'Ventas por Región', COUNT(DISTINCT r_name) FROM o
        UNION ALL SELECT 4, 'Distribución por Canal', COUNT(DISTINCT o_orderpriority) FROM o
        UNION ALL SELECT 5, 'Top 5 Productos', LEAST(5, COUNT(DISTINCT p_name || '|' || p_type))
            FROM t JOIN part ON producto_id = p_partkey
        UNION ALL SELECT 6, 'Tendencia Mensual', COUNT(DISTINCT strftime(fecha, '%Y-%m')) FROM t
        UNION ALL SELECT 7, 'Ventas por Día de Semana', COUNT(DISTINCT dayofweek(fecha)) FROM t""",
    "report_contents": report_contents(),
    "row_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in dict.fromkeys(f[0] for f in FIELDS)
    ),
    "csv_roundtrip": FEED_TOTALS,
    "jsonl_roundtrip": FEED_TOTALS,
    "partitioned_roundtrip": """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS year, COUNT(*) AS n,
               COUNT(DISTINCT month(o_orderdate)) AS months,
               CAST(SUM(CASE WHEN year(o_orderdate) = 1997 THEN 1
                        ELSE CAST(o_totalprice AS DECIMAL(12,2)) END) AS DOUBLE) AS total
        FROM orders GROUP BY 1""",
    "raw_archive": "SELECT COUNT(*) AS lines, CAST(SUM(event_id) AS BIGINT) AS id_sum FROM events",
    "idempotent_load": """SELECT o_orderstatus, COUNT(*) AS n,
            COUNT(DISTINCT o_orderkey) AS keys FROM orders GROUP BY o_orderstatus""",
    "surrogate_keys": """SELECT p_partkey, p_name,
            DENSE_RANK() OVER (ORDER BY p_name) AS name_id FROM part""",
    "lineage_summary": """WITH v AS (
            SELECT * FROM events WHERE user_id IN (
                SELECT c_custkey FROM customer WHERE c_acctbal > 0)),
        n AS (SELECT (SELECT COUNT(*) FROM events) AS a, (SELECT COUNT(*) FROM v) AS b,
                     (SELECT COUNT(*) FROM v WHERE event_type = 'purchase') AS c)
        SELECT 'integridad_referencial' AS transformacion, CAST(1 AS BIGINT) AS pasos,
               a AS filas_entrada, b AS filas_salida, a - b AS filas_eliminadas FROM n
        UNION ALL SELECT 'filtro_compras', 1, b, c, b - c FROM n""",
    "field_catalog": " UNION ALL ".join(
        f"SELECT '{t}' AS dataset, '{c}' AS campo, '{kind}' AS tipo, {need} AS obligatorio,"
        f" {pk} AS clave_primaria, COUNT(*) FILTER (WHERE {c} IS NULL) AS nulos,"
        f" COUNT(*) AS filas FROM {t}"
        for t, c, kind, need, pk in FIELDS
    ),
    "lineage_skipped": """WITH lines AS (
            SELECT CASE WHEN event_id % 7 = 0 THEN '(omitidas)' ELSE event_type END AS transformacion,
                   event_id % 7 = 0 AS lost, event_id, user_id FROM events WHERE event_id % 11 <> 0)
        SELECT transformacion, COUNT(*) AS pasos,
               CAST(SUM(event_id) FILTER (WHERE NOT lost) AS BIGINT) AS filas_entrada,
               CAST(SUM(user_id) FILTER (WHERE NOT lost) AS BIGINT) AS filas_salida,
               CAST(SUM(GREATEST(event_id - user_id, 0)) FILTER (WHERE NOT lost) AS BIGINT) AS filas_eliminadas
        FROM lines GROUP BY transformacion""",
    "nested_catalog": " UNION ALL ".join(
        f"SELECT '{t}' AS dataset, '{c}' AS campo, '{kind}' AS tipo, {need} AS obligatorio,"
        f" {pk} AS clave_primaria, COUNT(*) FILTER (WHERE {c} IS NULL) AS nulos,"
        f" COUNT(*) AS filas FROM {t}"
        for t, c, kind, need, pk in FIELDS
    ),
    "quality_document": " UNION ALL ".join(
        f"""SELECT '{name}' AS dataset, s.*, d.* FROM (
            WITH {flags} SELECT COUNT(*) AS rows_in, COUNT(*) FILTER (WHERE NOT bad) AS rows_out,
                MIN({col}) FILTER (WHERE NOT bad) AS min_value, MAX({col}) FILTER (WHERE NOT bad) AS max_value,
                {r('100.0 * COUNT(*) FILTER (WHERE bad) / GREATEST(COUNT(*), 1)', 2)} AS reject_pct,
                {r(f"CAST(SUM(CAST({col} AS DECIMAL(24,6))) FILTER (WHERE NOT bad) AS DOUBLE)"
                   f" / COUNT({col}) FILTER (WHERE NOT bad)", 4)} AS mean_value
            FROM (SELECT {col}, (f1 OR f2 OR f3 OR f4 OR f5 OR f6{more}) AS bad FROM flagged)) s,
            (WITH {flags} {_report(rules)}) d"""
        for name, flags, rules, col, more in (
            ("eventos", EVENT_FLAGS, EVENT_RULES, "value", " OR f7"),
            ("lineas", LINE_FLAGS, LINE_RULES, "l_extendedprice", ""),
        )
    ),
    "rule_catalog": f"""WITH {EVENT_FLAGS}, found AS ({_report(EVENT_RULES)}),
        names(id, nombre) AS (VALUES
            ('R01', 'Nulos obligatorios'), ('R02', 'Clave primaria duplicada'),
            ('R03', 'Rangos inválidos'), ('R04', 'Categorías no permitidas'),
            ('R05', 'Fechas futuras'), ('R06', 'Integridad referencial'),
            ('R07', 'Formato de identificador'), ('R08', 'Outliers estadísticos'))
        SELECT id, nombre, action AS accion, violations FROM found JOIN names ON id = rule""",
    "mcda_scores": f"""WITH {scored('l_suppkey', 'lineitem')}, {weights_cte({'base': 0})}
        SELECT alternative, total, {RANK} AS rank FROM totals""",
    "mcda_sensitivity": f"""WITH {scored('l_suppkey', 'lineitem')},
        {weights_cte({'base': 0, 'descuento+20': 20, 'descuento-10': -10})}
        SELECT scenario, alternative, total, {RANK} AS rank FROM totals""",
    "mcda_matrix": f"""WITH located AS (
            SELECT lineitem.*, r_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
            JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
        {scored('r_name', 'located')}, {weights_cte({'base': 0})}
        SELECT criterion, {r('100.0 * MAX(share)', 1)} AS weight_pct, {', '.join(
            f"CAST(MAX(score) FILTER (WHERE alternative = '{a}') AS DOUBLE) AS \"{a}\""
            for a in REGION_NAMES)}
        FROM scores JOIN shares USING (criterion) GROUP BY criterion
        UNION ALL SELECT 'TOTAL', 100.0::DOUBLE, {', '.join(
            r(f"MAX(total) FILTER (WHERE alternative = '{a}')", 2) for a in REGION_NAMES)}
        FROM totals""",
    "math_kernel": """SELECT l_linenumber,
            ROUND(SUM(list_sum(list_transform(range(0, 50),
                lambda i: sin(l_quantity) * cos(l_quantity + i)))), 6) AS kernel_sum,
            COUNT(*) AS n FROM lineitem GROUP BY l_linenumber""",
    "scaling_report": f"""WITH {RUN_LOG}
        SELECT job, p, ROUND(tp, 6) AS median_seconds, ROUND(s, 6) AS speedup,
               ROUND(s / p, 6) AS efficiency FROM report""",
    "amdahl_fit": f"""WITH {FIT}
        SELECT job, CAST(len(l) AS INTEGER) AS points,
               CASE WHEN f < 0.05 THEN 'highly parallel' WHEN f < 0.2 THEN 'moderate serial share'
                    ELSE 'serial share dominates' END AS verdict,
               ROUND(f0, 5) AS start_fraction, ROUND(f, 5) AS serial_fraction, ROUND(r2, 5) AS r2,
               ROUND(1.0 / f, 5) AS max_speedup,
               ROUND(1.0 / (f + (1.0 - f) / 8), 5) AS predicted_speedup
        FROM judged""",
    "medallion_zone_rows": f"""WITH txn AS (
            SELECT * FROM orders
            WHERE o_orderpriority <> '5-LOW' AND o_orderstatus IN ('F', 'O') AND o_totalprice > 0
              AND o_orderdate <= TIMESTAMP '2024-01-25 00:00:00'),
        evt AS (
            SELECT * FROM events
            WHERE event_type IN ('view', 'click', 'signup', 'purchase') AND value >= 0
              AND date_trunc('second', ts) <= TIMESTAMP '2024-01-25 00:00:00'
              AND user_id IN (SELECT o_custkey FROM txn))
        SELECT 'bronze' AS zone, 'transacciones' AS table_name, COUNT(*) AS row_count FROM orders
        UNION ALL SELECT 'bronze', 'eventos', COUNT(*) FROM events
        UNION ALL SELECT 'silver', 'transacciones', COUNT(*) FROM txn
        UNION ALL SELECT 'silver', 'eventos', COUNT(*) FROM evt
        UNION ALL SELECT 'gold', 'ventas_categoria_mes', COUNT(DISTINCT o_orderpriority ||
            strftime(o_orderdate, '%Y-%m')) FROM txn
        UNION ALL SELECT 'gold', 'perfil_usuarios', COUNT(DISTINCT o_custkey) FROM txn
        UNION ALL SELECT 'gold', 'conversion_funnel', 4""",
}
