"""Lookup joins that hold up when one key carries a large share of the rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercadal.session import local_table, materialize

# A key with more than 1/PIECES of all rows is split in pieces of that size, at
# any number of rows. There are fewer than PIECES such keys, and sketches of
# SKETCH_ITEMS items, merged in SKETCH_GROUPS groups that report HOT_KEYS keys
# each, are sure to hold them all. All other keys take the plain route.
PIECES = HOT_KEYS = 1024
SKETCH_ITEMS = 16 * HOT_KEYS
SKETCH_GROUPS = 256


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def frequent_keys(df: DataFrame, keys: Sequence[str]) -> list[tuple[int, int]]:
    """Hashes of the frequent keys with the number of pieces each is split in.

    One narrow pass and no shuffle by key: scan tasks build sketches, groups of
    tasks merge them, and the keys the groups report are added up. So no single
    task reads one sketch per scan task. The result, ``HOT_KEYS`` pairs at
    most, is fetched so that both sides of a join see the same split; the
    counts behind it are estimates, and any split gives the same rows.
    """
    group = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS))
    reported = (
        df.select(key_hash(keys).alias("_h"), group.alias("_g"))
        .groupBy("_g")
        .agg(
            F.expr(f"approx_top_k(_h, {HOT_KEYS}, {SKETCH_ITEMS})").alias("_top"),
            F.count(F.lit(1)).alias("_rows"),
        )
    )
    # a null item carries the rows of the group; summed it is the row count
    whole = F.struct(F.lit(None).cast("bigint").alias("item"), F.col("_rows").alias("count"))
    top = (
        reported.select(F.explode(F.concat("_top", F.array(whole))).alias("_t"))
        .groupBy(F.col("_t.item").alias("_hot"))
        .agg(F.sum("_t.count").alias("_n"))
        .orderBy(F.col("_hot").isNull().desc(), F.desc("_n"), "_hot")
        .limit(HOT_KEYS + 1)
        .collect()
    )
    if not top:
        return []
    piece = top[0]["_n"] / PIECES
    return [
        (row["_hot"], math.ceil(row["_n"] / piece)) for row in top[1:] if row["_n"] > piece
    ]


def lookup_join(
    fact: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    payload: Sequence[str],
    key_source: DataFrame | None = None,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Left join of ``fact`` with ``lookup``, which is unique on ``keys``.

    Keys compare null-safe; ``payload`` columns are null without a match. Rows
    of a frequent key are dealt out over its pieces and its lookup row is
    repeated once per piece, ``PIECES + HOT_KEYS`` repetitions at most in all.
    AQE turns the join into a broadcast when the lookup proves small.

    ``key_source`` is a frame with the same keys that is cheaper to scan than
    ``fact``. Rows are dealt by a hash of ``spread_by`` (all columns if not
    given), never by their position: a re-run task must deal them alike. Name
    the row's place there when full copies of a row may abound.
    """
    keys, payload = list(keys), list(payload)
    hot = frequent_keys(fact if key_source is None else key_source, keys)
    rows, copies = fact, lookup
    condition = F.lit(True)
    if hot:
        session = fact.sparkSession
        split = local_table(session, hot, "_hot long, _pieces long")
        pieces = F.coalesce(F.col("_pieces"), F.lit(1))
        dealt = F.pmod(F.xxhash64(*(spread_by or fact.columns)), pieces)
        is_hot = F.col("_h") == F.col("_hot")
        rows = (
            fact.withColumn("_h", key_hash(keys))
            .join(F.broadcast(split), is_hot, "left")
            .withColumn("_piece", dealt)
        )
        every = F.sequence(F.lit(0).cast("bigint"), pieces - F.lit(1))
        copies = (
            lookup.withColumn("_h", key_hash(keys))
            .join(F.broadcast(split), is_hot, "left")
            .withColumn("_copy", F.explode(every))
        )
        condition = F.col("_piece") == F.col("_copy")
    copies = copies.select(
        *[F.col(k).alias(f"_c_{k}") for k in keys],
        *[F.col(p).alias(f"_p_{p}") for p in payload],
        *(["_copy"] if hot else []),
    )
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_c_{key}"))
    joined = rows.join(copies, condition, "left")
    return joined.select(*fact.columns, *[F.col(f"_p_{p}").alias(p) for p in payload])


def counted_join(
    fact: DataFrame,
    counts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    payload: Sequence[str],
    spread_by: Sequence[str],
    store: bool = False,
) -> DataFrame:
    """Left join as in ``lookup_join``, with the split known from exact counts.

    ``counts`` has one row per key of ``fact`` with its number of rows ``_n``,
    as the caller has it at hand. Keys of more than 1/PIECES of the rows, fewer
    than PIECES by arithmetic, are broadcast with their number of pieces; no job
    runs before the result is asked for. Keys that ``lookup`` lacks may be left out
    of ``counts``: shares are then those among the others.

    With ``store`` the lookup is written first, so that its size is known when the
    join is planned: a small one is broadcast and ``fact`` is not shuffled at all.
    """
    keys, payload = list(keys), list(payload)
    total = counts.agg(F.sum("_n").alias("_total"))
    share = F.col("_n") * F.lit(PIECES) / F.col("_total")
    hot = F.broadcast(
        cross_one_row(counts, total)
        .where(share > 1)
        .select(*[F.col(k).alias(f"_hot_{k}") for k in keys], F.ceil(share).alias("_pieces"))
    )

    def matches(left: str, right: str) -> Column:
        condition = F.lit(True)
        for key in keys:
            condition = condition & F.col(f"{left}{key}").eqNullSafe(F.col(f"{right}{key}"))
        return condition

    pieces = F.coalesce(F.col("_pieces"), F.lit(1).cast("bigint"))
    rows = fact.join(hot, matches("", "_hot_"), "left").withColumn(
        "_piece", F.pmod(F.xxhash64(*spread_by), pieces)
    )
    copies = (
        lookup.join(hot, matches("", "_hot_"), "left")
        .withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), pieces - F.lit(1))))
        .select(
            *[F.col(k).alias(f"_c_{k}") for k in keys],
            *[F.col(p).alias(f"_p_{p}") for p in payload],
            "_copy",
        )
    )
    if store:
        copies = materialize(copies, "lookup")
    joined = rows.join(copies, matches("", "_c_") & (F.col("_piece") == F.col("_copy")), "left")
    return joined.select(*fact.columns, *[F.col(f"_p_{p}").alias(p) for p in payload])


def with_membership(
    fact: DataFrame,
    members: DataFrame,
    fact_key: str,
    member_key: str,
    out: str,
    key_source: DataFrame | None = None,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Boolean column: does the key occur in ``members``? Null keys do not."""
    known = (
        members.where(F.col(member_key).isNotNull())
        .select(F.col(member_key).alias(fact_key))
        .distinct()
        .withColumn(out, F.lit(True))
    )
    joined = lookup_join(fact, known, [fact_key], [out], key_source, spread_by)
    return joined.withColumn(out, F.coalesce(F.col(out), F.lit(False)))


def semi_join(
    fact: DataFrame,
    members: DataFrame,
    fact_key: str,
    member_key: str,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Rows whose key occurs in ``members``."""
    flagged = with_membership(
        fact, members, fact_key, member_key, "_member", spread_by=spread_by
    )
    return flagged.where("_member").drop("_member")


def anti_join(
    fact: DataFrame,
    members: DataFrame,
    fact_key: str,
    member_key: str,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Rows with a non-null key that does not occur in ``members``."""
    flagged = with_membership(
        fact, members, fact_key, member_key, "_member", spread_by=spread_by
    )
    return flagged.where(~F.col("_member") & F.col(fact_key).isNotNull()).drop("_member")


def cross_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame, e.g. a threshold, to every row."""
    return df.join(F.broadcast(one_row), how="cross")
