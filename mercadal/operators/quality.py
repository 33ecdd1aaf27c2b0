"""Applies a rule set: flags, clean rows, violation report, statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercadal.functions.exact import exact_means
from mercadal.functions.scalars import percent
from mercadal.operators.rules import DROP, Context, Rule
from mercadal.session import materialize


PLACE_COLUMNS = ("_file", "_block_start", "_row_id")


@dataclass(frozen=True)
class QualityResult:
    """Lazy frames of one rule set. ``summary`` is one row that both the report
    and the statistics are unfolded from; it takes a single scan of the columns
    the rules touch."""

    flagged: DataFrame
    clean: DataFrame
    summary: DataFrame
    rules: Sequence[Rule]

    @property
    def report(self) -> DataFrame:
        return violation_report(self.summary, self.rules)

    @property
    def stats(self) -> DataFrame:
        return dataset_stats(self.summary)

    def stored(self) -> QualityResult:
        """The same result with the summary computed once and kept."""
        return replace(self, summary=materialize(self.summary.coalesce(1), "summary"))


def apply_rules(
    df: DataFrame,
    rules: Sequence[Rule],
    as_of,
    refs: Mapping[str, DataFrame] | None = None,
    stats_column: str | None = None,
    store: bool = False,
) -> QualityResult:
    """Evaluates every rule on the raw rows and filters once at the end, so the
    later copies of a key go even when its first copy is dropped by another rule.

    With ``store`` the flagged rows are written once, at once; clean rows, report
    and statistics all read them there."""
    place = tuple(c for c in PLACE_COLUMNS if c in df.columns)
    context = Context(as_of, refs or {}, df, place, store)
    flagged = df
    for rule in rules:
        flagged = rule.flag_builder(flagged, context, rule.flag)
    bad = F.lit(False)
    for rule in rules:
        if rule.action == DROP:
            bad = bad | F.col(rule.flag)
    flagged = flagged.withColumn("_rejected", bad)
    if store:
        flagged = materialize(flagged, "flagged")
    clean = flagged.where(~F.col("_rejected")).select(*df.columns)
    return QualityResult(flagged, clean, summarize(flagged, rules, stats_column), rules)


def summarize(flagged: DataFrame, rules: Sequence[Rule], column: str | None = None) -> DataFrame:
    """One row: rows in and out, violations per rule, notes, measures of ``column``."""
    kept = ~F.col("_rejected")
    measures = {"rows_in": ("sum", F.count(F.lit(1))), "rows_out": ("sum", F.count_if(kept))}
    measures |= {r.flag: ("sum", F.count_if(F.col(r.flag))) for r in rules}
    measures |= {r.note: ("max", F.max(r.note)) for r in rules if r.note in flagged.columns}
    if not column:
        return flagged.agg(*[made.alias(name) for name, (_, made) in measures.items()])
    value = F.when(kept, F.col(column))
    measures |= {"min_value": ("min", F.min(value)), "max_value": ("max", F.max(value))}
    return exact_means(flagged, [], value, "mean_value", measures)


def violation_report(summary: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule, in rule order, with the action the rule really takes."""

    def entry(rule: Rule):
        text = F.lit(rule.description)
        if rule.note in summary.columns:
            limit = F.coalesce(F.col(rule.note), F.lit(float("nan")))
            text = F.concat(text, F.format_string(" (> %.2f)", limit))
        return F.struct(
            F.lit(rule.id).alias("rule"),
            text.alias("description"),
            F.col(rule.flag).alias("violations"),
            F.lit(rule.action).alias("action"),
        )

    rows = summary.select("rows_in", F.posexplode(F.array(*[entry(r) for r in rules])))
    return rows.orderBy("pos").select(
        "col.rule",
        "col.description",
        "col.violations",
        percent(F.col("col.violations"), F.greatest("rows_in", F.lit(1))).alias("pct"),
        "col.action",
    )


def dataset_stats(summary: DataFrame) -> DataFrame:
    """Rows in and out, reject rate, and min / max / mean of the clean measure."""
    lost = F.col("rows_in") - F.col("rows_out")
    rate = percent(lost, F.greatest("rows_in", F.lit(1)))
    known = [c for c in ("min_value", "max_value", "mean_value") if c in summary.columns]
    return summary.select("rows_in", "rows_out", *known, rate.alias("reject_pct"))


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key under ``order``, which must cover the other columns.

    An aggregate instead of a window: copies of a key collapse before the
    shuffle, so no task ever sorts a whole group.
    """
    best = df.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in order])
