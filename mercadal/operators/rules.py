"""Declarative data-quality rules.

A rule says how to flag a raw row; whether flagged rows are dropped or only
reported is its action. Rules that need more than the row itself (duplicates,
references, outlier thresholds) attach their flag with a join first.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercadal.functions.scalars import stamp_literal
from mercadal.operators.joins import counted_join, cross_one_row
from mercadal.operators.ranking import exact_quantiles
from mercadal.session import materialize

DROP, REPORT = "drop", "report"


@dataclass(frozen=True)
class Context:
    """What a rule may need besides the rows being flagged: the reference
    instant, the frames that foreign keys point to, the raw frame, and the
    columns that tell a row's place. Rules that aggregate read the raw frame,
    not the flags attached so far. With ``store`` they write the keys that they
    look up (those repeated or unknown) first: small ones are then broadcast and
    the rows stay where they are; without it no job runs before the result is
    asked for."""

    as_of: object
    refs: Mapping[str, DataFrame] = field(default_factory=dict)
    raw: DataFrame | None = None
    place: tuple[str, ...] = ()
    store: bool = False


@dataclass(frozen=True)
class Rule:
    id: str
    description: str
    flag_builder: Callable[[DataFrame, Context, str], DataFrame]
    action: str = DROP
    fields: tuple[str, ...] = ()
    kind: str = ""
    allowed: tuple[str, ...] | None = None
    pattern: str | None = None

    @property
    def flag(self) -> str:
        return f"_v_{self.id}"

    @property
    def note(self) -> str:
        """Name of an optional numeric detail, e.g. an outlier threshold."""
        return f"_n_{self.id}"


def _row_rule(id_, description, fields, predicate, kind, **detail) -> Rule:
    def build(df: DataFrame, ctx: Context, out: str) -> DataFrame:
        return df.withColumn(out, F.coalesce(predicate(ctx), F.lit(False)))

    return Rule(id_, description, build, DROP, tuple(fields), kind, **detail)


def not_null(id_: str, fields: Sequence[str], description: str) -> Rule:
    def predicate(_ctx: Context) -> Column:
        missing = F.lit(False)
        for name in fields:
            missing = missing | F.col(name).isNull()
        return missing

    return _row_rule(id_, description, fields, predicate, "required")


def out_of_range(id_: str, column: str, bad: Callable[[Column], Column], description: str) -> Rule:
    """``bad`` maps the column to the violation; null never violates."""
    return _row_rule(id_, description, [column], lambda _ctx: bad(F.col(column)), "range")


def allowed(id_: str, column: str, values: Sequence[str], description: str) -> Rule:
    """For the short vocabularies of a feed; use ``references`` for long ones."""
    return _row_rule(
        id_,
        description,
        [column],
        lambda _ctx: ~F.col(column).isin(*values),
        "vocabulary",
        allowed=tuple(values),
    )


def not_future(id_: str, column: str, description: str) -> Rule:
    return _row_rule(
        id_, description, [column], lambda ctx: F.col(column) > stamp_literal(ctx.as_of), "future"
    )


def matches(id_: str, column: str, pattern: str, description: str) -> Rule:
    """Null violates the format, unlike in the other rules."""
    return _row_rule(
        id_,
        description,
        [column],
        lambda _ctx: ~F.coalesce(F.col(column).rlike(pattern), F.lit(False)),
        "format",
        pattern=pattern,
    )


# bits of a row's number within its file or block; above them, the number of that split
ROW_BITS = 33


def split_numbers(df: DataFrame, split: Sequence[str]) -> DataFrame:
    """Files or blocks in their order, as (hash of the split, number): 16 bytes
    for each file that the driver lists anyway."""
    found = df.select(*split).distinct()
    numbered = found.select(
        F.xxhash64(*split).alias("_split"),
        (F.row_number().over(Window.orderBy(*split)) - 1).cast("bigint").alias("_number"),
    )
    return numbered.groupBy("_split").agg(F.min("_number").alias("_number"))


def with_place(df: DataFrame, splits: DataFrame, order: Sequence[str]) -> DataFrame:
    """``_place``: the row's place among all rows as one long."""
    *split, row = order
    numbered = df.withColumn("_key", F.xxhash64(*split)).join(
        F.broadcast(splits), F.col("_key") == F.col("_split"), "left"
    )
    within = F.col(row).cast("bigint").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    place = F.shiftleft("_number", ROW_BITS).bitwiseOR(within)
    return numbered.select(*df.columns, place.alias("_place"))


def first_occurrence(
    id_: str, keys: Sequence[str], order: Sequence[str], description: str
) -> Rule:
    """Flags every row of a key but the first under ``order``; nulls are equal.

    ``order`` names a row's file, in some feeds its block, and last the row's
    number there (its lowest 33 bits count). They become one long, so that rows
    and first place per key are one hash aggregate: a key with very many copies
    shrinks to one row before it is shuffled. Only the keys that do repeat are
    joined back, split by the counts just taken.
    """
    keys, order = list(keys), list(order)

    def build(df: DataFrame, ctx: Context, out: str) -> DataFrame:
        raw = df if ctx.raw is None else ctx.raw
        splits = split_numbers(raw, order[:-1])
        counts = (
            with_place(raw.select(*dict.fromkeys([*keys, *order])), splits, order)
            .groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
        )
        placed = with_place(df, splits, order)
        repeated = counts.where("_n > 1")
        if ctx.store:
            counts = repeated = materialize(repeated, "repeated")
        joined = counted_join(placed, counts, repeated, keys, ["_first"], ["_place"], ctx.store)
        later = F.coalesce(F.col("_place") > F.col("_first"), F.lit(False))
        return joined.withColumn(out, later).drop("_first", "_place")

    return Rule(id_, description, build, DROP, tuple(keys), "key")


def references(id_: str, column: str, ref: str, ref_column: str, description: str) -> Rule:
    """Flags non-null keys absent from the frame registered as ``ref``.

    The distinct keys of the column are looked up, and the few that are missing
    are joined back to the rows, split by their counts.
    """

    def build(df: DataFrame, ctx: Context, out: str) -> DataFrame:
        raw = df if ctx.raw is None else ctx.raw
        counts = raw.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
        known = ctx.refs[ref].select(F.col(ref_column).alias("_known"))
        missing = (
            counts.where(F.col(column).isNotNull())
            .join(known, F.col(column) == F.col("_known"), "left_anti")
            .withColumn("_orphan", F.lit(True))
        )
        if ctx.store:
            counts = missing = materialize(missing, "missing")
        joined = counted_join(df, counts, missing, [column], ["_orphan"], ctx.place or raw.columns, ctx.store)
        return joined.withColumn(out, F.col("_orphan").isNotNull()).drop("_orphan")

    return Rule(id_, description, build, DROP, (column,), "reference")


def iqr_outlier(id_: str, column: str, description: str, factor: float = 3.0) -> Rule:
    """Flags values above Q3 + factor * IQR of the raw column; report only."""

    def build(df: DataFrame, ctx: Context, out: str) -> DataFrame:
        limit = outlier_threshold(df if ctx.raw is None else ctx.raw, column, factor, ctx.store)
        note = f"_n_{id_}"
        judged = cross_one_row(df, limit.withColumnRenamed("threshold", note))
        return judged.withColumn(out, F.coalesce(F.col(column) > F.col(note), F.lit(False)))

    return Rule(id_, description, build, REPORT, (column,), "outlier")


def outlier_threshold(df: DataFrame, column: str, factor: float = 3.0, store: bool = False) -> DataFrame:
    """One row: ``threshold`` = Q3 + factor * (Q3 - Q1) with exact quartiles."""
    quartiles = exact_quantiles(df, column, {"_q1": 0.25, "_q3": 0.75}, store=store)
    spread = F.col("_q3") - F.col("_q1")
    return quartiles.select((F.col("_q3") + F.lit(factor) * spread).alias("threshold"))
