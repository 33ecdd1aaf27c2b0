"""Typing and validation of the two feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercadal.functions.layouts import DEFAULT, Layout
from mercadal.functions.scalars import lenient_number
from mercadal.operators.quality import QualityResult, apply_rules
from mercadal.operators.rules import Rule
from mercadal.schemas import ORDINAL, event_rules, transaction_rules


def typed_transactions(bronze: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    """Lenient casts of the text columns; whatever does not parse is null.
    ``layout`` is that of the feed's stamps."""
    return bronze.withColumns(
        {
            "amount": lenient_number(F.col("amount")),
            "quantity": lenient_number(F.col("quantity")),
            "date": layout.stamp(F.col("date")),
        }
    )


def typed_events(bronze: DataFrame, layout: Layout = DEFAULT) -> DataFrame:
    return bronze.withColumns(
        {
            "duration_sec": lenient_number(F.col("duration_sec")),
            "timestamp": layout.stamp(F.col("timestamp")),
        }
    )


def validate_transactions(
    bronze: DataFrame,
    as_of,
    rules: Sequence[Rule] | None = None,
    strict: bool = False,
    layout: Layout = DEFAULT,
    store: bool = False,
) -> tuple[DataFrame, QualityResult]:
    """Clean transactions with year and month, and the full result.

    A null quantity violates no rule; it is kept as null, or fails the run in
    strict mode. ``store`` is that of ``apply_rules``.
    """
    result = apply_rules(
        typed_transactions(bronze, layout), rules or transaction_rules(), as_of, stats_column="amount", store=store
    )
    quantity = F.col("quantity").cast("int")
    if strict:
        failure = F.raise_error(F.lit("quantity is null in a clean row"))
        quantity = F.when(quantity.isNull(), failure.cast("int")).otherwise(quantity)
    clean = (
        result.clean.drop(*ORDINAL)
        .withColumn("quantity", quantity)
        .withColumns({"year": F.year("date"), "month": F.month("date")})
    )
    return clean, result


def validate_events(
    bronze: DataFrame,
    clean_transactions: DataFrame,
    as_of,
    rules: Sequence[Rule] | None = None,
    layout: Layout = DEFAULT,
    store: bool = False,
) -> tuple[DataFrame, QualityResult]:
    """Clean events; their users must occur in the clean transactions."""
    result = apply_rules(
        typed_events(bronze, layout),
        rules or event_rules(),
        as_of,
        refs={"users": clean_transactions},
        stats_column="duration_sec",
        store=store,
    )
    clean = result.clean.drop(*ORDINAL).withColumns(
        {"year": F.year("timestamp"), "month": F.month("timestamp")}
    )
    return clean, result
