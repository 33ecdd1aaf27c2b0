"""The medallion run: feeds, bronze, silver, gold, queries, catalog, lineage."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from mercadal.functions.layouts import feed_layout
from mercadal.operators.rules import Rule
from mercadal.plans import analytics, gold, governance, silver
from mercadal.schemas import CATEGORIES, EVENT_FEED, FUNNEL_STEPS, TRANSACTION_FEED
from mercadal.session import local_table, materialize
from mercadal.sources import datagen, readers, writers


@dataclass
class PipelineConfig:
    """Folders, feeds and the reference instant of one run.

    Without feed paths the feeds are generated under the root. Rule sets can
    be replaced for feeds with other vocabularies.
    """

    root: str
    as_of: object
    transactions_path: str | None = None
    events_path: str | None = None
    transactions: int = 5_000
    events: int = 8_000
    seed: int = 42
    empty_as_null: bool = False
    id_width: tuple[int, int] = (6, 7)
    transaction_rules: Sequence[Rule] | None = None
    event_rules: Sequence[Rule] | None = None
    categories: Sequence[str] = field(default_factory=lambda: list(CATEGORIES))
    funnel_steps: Sequence[str] = field(default_factory=lambda: list(FUNNEL_STEPS))


@dataclass
class PipelineRun:
    bronze: dict[str, DataFrame]
    silver: dict[str, DataFrame]
    gold: dict[str, DataFrame]
    results: dict[str, DataFrame]
    report: DataFrame
    lineage: DataFrame


def together(*actions: Callable[[], object]) -> list:
    """Runs independent Spark actions at the same time; the first error is raised.

    Their stages share the executors, so a step that leaves cores idle (a small
    table, the tail of a skewed stage) does not hold up the others.
    """
    with ThreadPoolExecutor(len(actions)) as pool:
        return [f.result() for f in [pool.submit(action) for action in actions]]


class _Steps:
    """Times a step, counts its result and keeps its lineage record."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.records = spark, path, []

    def run(
        self, origin: str, step: str, target: str, script: str, rows_in: int | None,
        notes: str, action: Callable[[], DataFrame], started: float | None = None,
    ) -> tuple[DataFrame, int]:
        """``started`` is given for a step that began before ``action``."""
        started = time.monotonic() if started is None else started
        stored = action()
        seconds = time.monotonic() - started
        rows_out = stored.count()  # zero columns read: row counts of the footers
        self.records.append(
            {
                "origin": origin, "step": step, "target": target, "script": script,
                "rows_in": rows_out if rows_in is None else rows_in, "rows_out": rows_out,
                "notes": notes, "seconds": round(seconds, 3),
            }
        )
        return stored, rows_out

    def log(self) -> None:
        """Appends the records kept since the last call, in one small write."""
        governance.log_lineage(self.spark, self.path, *self.records)
        self.records = []


def generate_feeds(spark: SparkSession, cfg: PipelineConfig) -> tuple[str, str]:
    txn_path, evt_path = f"{cfg.root}/seeds/transacciones.csv", f"{cfg.root}/seeds/eventos.jsonl"
    writers.write_csv(
        datagen.synthetic_transactions(spark, cfg.transactions, cfg.seed, cfg.id_width[0]), txn_path
    )
    writers.write_jsonl(
        datagen.synthetic_events(spark, cfg.events, cfg.seed + 1, cfg.id_width[1]), evt_path
    )
    return txn_path, evt_path


def run_pipeline(spark: SparkSession, cfg: PipelineConfig) -> PipelineRun:
    """Every zone is written once and the next one reads what was written."""
    steps = _Steps(spark, f"{cfg.root}/metadata/linaje")
    txn_path, evt_path = cfg.transactions_path, cfg.events_path
    if txn_path is None or evt_path is None:
        made_txn, made_evt = generate_feeds(spark, cfg)
        txn_path, evt_path = txn_path or made_txn, evt_path or made_evt

    # bronze
    feeds = {
        "transacciones": (txn_path, "csv", TRANSACTION_FEED),
        "eventos": (evt_path, "jsonl", EVENT_FEED),
    }

    def ingest(name: str):
        path, fmt, schema = feeds[name]
        source = readers.read_source(spark, path, fmt, schema, empty_as_null=cfg.empty_as_null)
        target = f"{cfg.root}/bronze/{name}.parquet"
        return steps.run(
            path, "ingesta_raw", target, "mercadal/sources/readers.py", None, f"formato {fmt}",
            lambda: writers.write_zone(source, target),
        )

    def archive(name: str):
        return writers.archive_raw(spark, feeds[name][0], f"{cfg.root}/bronze/raw/{name}")

    (raw_txn, txn_in), (raw_evt, evt_in), *_ = together(
        lambda: ingest("transacciones"),
        lambda: ingest("eventos"),
        lambda: archive("transacciones"),
        lambda: archive("eventos"),
    )
    steps.log()

    # the layouts of the stamps, found in one scan per feed and stored with the run
    txn_layout, evt_layout = together(
        lambda: feed_layout(raw_txn, "date"), lambda: feed_layout(raw_evt, "timestamp")
    )
    known = [("transacciones", "date", txn_layout.name), ("eventos", "timestamp", evt_layout.name)]
    writers.write_jsonl(
        local_table(spark, known, "feed string, campo string, formato string"),
        f"{cfg.root}/metadata/formatos",
    )

    # silver: each feed is judged once, and its flagged rows are stored; events
    # need the users of the clean transactions, so theirs are judged while those
    # are written to their zone
    layout = ["year", "month"]

    def refine(name: str, clean: DataFrame, rows_in: int, rules: str, started: float):
        target = f"{cfg.root}/silver/{name}"
        return steps.run(
            f"{cfg.root}/bronze/{name}.parquet", f"validacion_calidad_{rules}", target,
            "mercadal/plans/silver.py", rows_in, "por year/month",
            lambda: writers.write_zone(clean, target, layout), started,
        )

    begun = time.monotonic()
    clean_txn, txn_quality = silver.validate_transactions(
        raw_txn, cfg.as_of, cfg.transaction_rules, layout=txn_layout, store=True
    )

    def refine_events():
        begun = time.monotonic()
        clean_evt, quality = silver.validate_events(
            raw_evt, clean_txn, cfg.as_of, cfg.event_rules, layout=evt_layout, store=True
        )
        return refine("eventos", clean_evt, evt_in, "R01-R07", begun), quality

    (txn, txn_rows), ((evt, evt_rows), evt_quality), txn_quality = together(
        lambda: refine("transacciones", clean_txn, txn_in, "R01-R08", begun),
        refine_events,
        txn_quality.stored,
    )
    steps.log()

    # gold, while the event report is counted
    def gold_step(name, build, step, origin, rows_in, partitioned=False):
        target = f"{cfg.root}/gold/{name}" + ("" if partitioned else ".parquet")
        return steps.run(
            origin, step, target, "mercadal/plans/gold.py", rows_in, "",
            lambda: writers.write_zone(
                gold.stamped(build()), target, layout if partitioned else None
            ),
        )[0]

    ventas, perfil, embudo, evt_quality = together(
        lambda: gold_step(
            "ventas_categoria_mes", lambda: gold.ventas_categoria_mes(txn),
            "aggregation_ventas_categoria_mes", "silver/transacciones", txn_rows, True,
        ),
        lambda: gold_step(
            # stored, as a range sort reads its input twice
            "perfil_usuarios",
            lambda: gold.sorted_profiles(materialize(gold.perfil_usuarios(txn, evt), "perfil")),
            "join_perfil_usuarios", "silver/transacciones + silver/eventos", txn_rows + evt_rows,
        ),
        lambda: gold_step(
            "conversion_funnel", lambda: gold.funnel(evt, cfg.funnel_steps),
            "conversion_funnel_by_session", "silver/eventos", evt_rows,
        ),
        evt_quality.stored,
    )
    steps.log()
    golds = {
        "ventas_categoria_mes": ventas,
        "perfil_usuarios": perfil,
        "conversion_funnel": embudo,
    }

    # queries, report and catalog
    scores = analytics.rfm_scores(perfil)
    results = {
        "top_categorias": analytics.top_categorias(ventas),
        "serie_temporal": analytics.serie_temporal(ventas),
        "rfm_usuarios": scores,
        "rfm_segmentos": analytics.rfm_segments(scores),
        "dispositivos": analytics.comportamiento_dispositivos(evt),
        "geo": analytics.desempeno_por_pais(ventas),
        "pais_categoria": analytics.pais_por_categoria(ventas, cfg.categories),
    }
    saved = ("top_categorias", "serie_temporal", "rfm_segmentos", "geo")
    report, *_ = together(
        lambda: writers.write_quality_report(
            {"transacciones": txn_quality.report, "eventos": evt_quality.report},
            {"transacciones": txn_quality.stats, "eventos": evt_quality.stats},
            f"{cfg.root}/metrics",
        ),
        lambda: governance.write_catalog(spark, f"{cfg.root}/metadata/catalogo"),
        *[
            lambda name=name: writers.write_query_results(
                {name: results[name]}, f"{cfg.root}/metrics"
            )
            for name in saved
        ],
    )
    lineage = readers.read_lineage(spark, f"{cfg.root}/metadata/linaje")
    return PipelineRun(
        {"transacciones": raw_txn, "eventos": raw_evt},
        {"transacciones": txn, "eventos": evt},
        golds, results, report, lineage,
    )
