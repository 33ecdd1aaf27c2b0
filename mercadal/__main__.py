"""Command line: ``python -m mercadal medallion|ventas --root FOLDER [...]``."""

from __future__ import annotations

import argparse
from datetime import UTC, datetime

from pyspark.sql import SparkSession

from mercadal.plans import governance, sales
from mercadal.plans.pipeline import PipelineConfig, run_pipeline
from mercadal.session import build_session, scratch_scope, size_shuffles
from mercadal.sources.datagen import CHANNEL_WEIGHTS, write_star
from mercadal.sources.writers import write_text_report, write_zone


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="mercadal")
    jobs = top.add_subparsers(dest="job", required=True)

    medallion = jobs.add_parser("medallion", help="bronze, silver and gold over the two feeds")
    medallion.add_argument("--root", required=True, help="folder of the zones")
    medallion.add_argument("--transacciones-path", help="CSV feed; generated when absent")
    medallion.add_argument("--eventos-path", help="JSON-lines feed; generated when absent")
    medallion.add_argument("--transacciones", type=int, default=5_000, help="rows to generate")
    medallion.add_argument("--eventos", type=int, default=8_000, help="rows to generate")
    medallion.add_argument("--seed", type=int, default=42)
    medallion.add_argument("--as-of", help="reference instant, default now (UTC)")
    medallion.add_argument("--empty-as-null", action="store_true")

    ventas = jobs.add_parser("ventas", help="sales star and its text report")
    ventas.add_argument("--root", required=True)
    ventas.add_argument("--transacciones", type=int, default=2_000, help="sales to generate")
    ventas.add_argument("--seed", type=int, default=44)
    return top


def run_job(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "medallion":
        size_shuffles(spark, *filter(None, [args.transacciones_path, args.eventos_path]))
        now = datetime.now(UTC).replace(tzinfo=None, microsecond=0)
        run = run_pipeline(
            spark,
            PipelineConfig(
                root=args.root,
                as_of=args.as_of or now,
                transactions_path=args.transacciones_path,
                events_path=args.eventos_path,
                transactions=args.transacciones,
                events=args.eventos,
                seed=args.seed,
                empty_as_null=args.empty_as_null,
            ),
        )
        run.report.show(100, truncate=False)
        governance.lineage_table(run.lineage).show(100, truncate=False)
    else:
        star = write_star(spark, args.root, args.transacciones, args.seed)
        fact, products = star["transacciones"], star["productos"]
        write_zone(sales.reporte_diario(fact, products), f"{args.root}/reporte_diario")
        channels = [name for name, _ in CHANNEL_WEIGHTS]
        sections = sales.full_report(fact, products, channels)
        write_text_report(sections, f"{args.root}/reporte")
        for title, frame in sections:
            print(title)
            frame.show(50, truncate=False)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session()
    with scratch_scope(spark):
        run_job(spark, args)


if __name__ == "__main__":
    main()
