"""Document fingerprints as invertible Bloom lookup sketches.

A text falls into paragraphs: lines, and within lines sentences. A paragraph and
the number of times it stands in the text make one item, a 64-bit digest. The
sketch hashes each item to one cell of each of three tables; a cell holds the
number of its items and the exclusive or of their digests and of their checks.

Two versions are compared by subtracting cell by cell and peeling: a cell with a
single item gives it up, it is taken from its other cells, and so on. If
something is left over, the items of both versions are dealt into groups by
their digest, each with sketches of its own, retried with twice the cells until
all is peeled (after ``SIZES`` the group's digests are compared themselves).
Likeness is one minus the share of items that differ.

Only DataFrame functions are used. Null texts count as empty, and the empty text
is one empty paragraph. Documents follow each other by descending ``doc_id``,
null ids last, equal ids by their texts' hashes; rows alike in both count as one
document in that order and get a row each. Extra columns are not read, an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercadal.llm.tables import stored, text_or_empty
from mercadal.operators.ranking import distributed_row_number

PARAGRAPH_END = r"\n|(?<=[.!?])[ \t]+"
BASE_CELLS = 8  # per table
GROUP_ITEMS = 12  # a group gets six to twelve items on average
SIZES = (8, 16, 32, 64, 128)
ROUNDS = 16
TABLES = ("a", "b", "c")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def items_of(text: Column) -> Column:
    """Distinct digests of (paragraph, times it stands in the text), sorted."""
    digests = F.array_sort(F.transform(F.split(text, PARAGRAPH_END, -1), lambda p: F.xxhash64(p)))

    def counted(d: Column) -> Column:
        fresh = F.filter(
            F.sequence(F.lit(0), F.size(d) - 1), lambda i: (i == 0) | (F.get(d, i) != F.get(d, F.greatest(i - 1, F.lit(0))))
        )

        def with_counts(starts: Column) -> Column:
            def item(at: Column, i: Column) -> Column:
                return F.xxhash64(F.get(d, at), F.coalesce(F.get(starts, i + 1), F.size(d)) - at)

            return F.transform(starts, item)

        return let(fresh, with_counts)

    return F.array_sort(let(digests, counted))


def spot(key: Column, n: Column, cells: Column) -> Column:
    """An item with its check and its cell in each of the tables of ``cells`` cells."""

    def place(h: Column) -> Column:
        mask = cells - 1
        found = [F.shiftright(h, 8 * k).bitwiseAND(mask).cast("int").alias(t) for k, t in enumerate(TABLES)]
        return F.struct(n.alias("n"), key.alias("key"), F.shiftright(h, 32).alias("chk"), *found)

    return let(F.xxhash64(key, cells), place)


def put(cell: Column, index: Column, table: str, spots: Column, sign: int) -> Column:
    """The cell after adding (1) or taking away (-1) the items that belong to it."""

    def one(state: Column, s: Column) -> Column:
        n = state["n"] + s["n"] if sign > 0 else state["n"] - s["n"]
        changed = F.struct(
            n.alias("n"), state["key"].bitwiseXOR(s["key"]).alias("key"), state["chk"].bitwiseXOR(s["chk"]).alias("chk")
        )
        return F.when(s[table] == index, changed).otherwise(state)

    return F.aggregate(spots, cell, one)


def long(value: int) -> Column:
    return F.lit(value).cast("long")


def per_table(make: Callable[[str], Column]) -> Column:
    return F.struct(*[make(t).alias(t) for t in TABLES])


def sketch(items: Column, cells: Column, sign: Callable[[Column], tuple[Column, Column]] | None = None) -> Column:
    """Three tables of ``cells`` cells. ``sign`` gives digest and count of an entry
    of ``items``; by itself each entry is a digest of count 1."""
    empty = F.struct(long(0).alias("n"), long(0).alias("key"), long(0).alias("chk"))
    spots = F.transform(items, lambda x: spot(*(sign(x) if sign else (x, long(1))), cells))
    places = F.sequence(F.lit(0), cells.cast("int") - 1)
    return let(spots, lambda s: per_table(lambda t: F.transform(places, lambda i: put(empty, i, t, s, 1))))


def subtracted(a: Column, b: Column) -> Column:
    def cell(x: Column, y: Column) -> Column:
        return F.struct(
            (x["n"] - y["n"]).alias("n"), x["key"].bitwiseXOR(y["key"]).alias("key"), x["chk"].bitwiseXOR(y["chk"]).alias("chk")
        )

    return per_table(lambda t: F.zip_with(a[t], b[t], cell))


def peeled(difference: Column, cells: Column) -> Column:
    """struct(cells, found, done): what is left and the digests recovered."""
    none = F.array().cast("array<bigint>")
    start = F.struct(difference.alias("cells"), none.alias("found"), F.lit(False).alias("done"))

    def round_(state: Column, _i: Column) -> Column:
        return F.when(state["done"], state).otherwise(next_state(state))

    def next_state(state: Column) -> Column:
        alone = F.concat(*[F.filter(state["cells"][t], lambda c: F.abs(c["n"]) == 1) for t in TABLES])
        spots = F.transform(alone, lambda c: F.struct(spot(c["key"], c["n"], cells).alias("s"), c["chk"].alias("chk")))
        true = F.filter(spots, lambda x: x["s"]["chk"] == x["chk"])
        pure = F.array_distinct(F.transform(true, lambda x: x["s"]))

        def take(p: Column) -> Column:
            left = per_table(lambda t: F.transform(state["cells"][t], lambda c, i: put(c, i, t, p, -1)))
            found = F.concat(state["found"], F.transform(p, lambda s: s["key"]))
            stuck = F.struct(state["cells"].alias("cells"), state["found"].alias("found"), F.lit(True).alias("done"))
            peeled_on = F.struct(left.alias("cells"), found.alias("found"), F.lit(False).alias("done"))
            return F.when(F.size(p) > 0, peeled_on).otherwise(stuck)

        return let(pure, take)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, round_)


def recovered(difference: Column, cells: Column) -> Column:
    """Number of digests that peeling recovers from the difference of two
    sketches; null if some stay."""

    def judge(p: Column) -> Column:
        # an item left over would stand in each table
        clear = F.forall(p["cells"][TABLES[0]], lambda c: (c["n"] == 0) & (c["key"] == 0) & (c["chk"] == 0))
        return F.when(clear, F.size(p["found"]))

    return let(peeled(difference, cells), judge)


def grouped_difference(a: Column, b: Column) -> Column:
    """Number of differing digests of two item lists by grouped, growing sketches.

    The items of both lists, sorted by digest, fall into runs that share their
    leading bits, about ``GROUP_ITEMS`` to a run, so the work is linear in the
    length of the texts.
    """
    both = F.array_sort(
        F.concat(
            F.transform(a, lambda x: F.struct(x.alias("key"), F.lit(True).alias("left"))),
            F.transform(b, lambda x: F.struct(x.alias("key"), F.lit(False).alias("left"))),
        )
    )
    share = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(F.size(a) + F.size(b), F.lit(GROUP_ITEMS)) / GROUP_ITEMS)))

    def group_of(x: Column, groups: Column) -> Column:
        return F.floor((x["key"].cast("double") / float(1 << 64) + 0.5) * groups)

    def difference(s: Column, groups: Column) -> Column:
        last = F.size(s) - 1
        fresh = F.filter(
            F.sequence(F.lit(0), last),
            lambda i: (i == 0) | (group_of(F.get(s, i), groups) != group_of(F.get(s, F.greatest(i - 1, F.lit(0))), groups)),
        )

        def per_group(starts: Column) -> Column:
            def one(at: Column, i: Column) -> Column:
                part = F.slice(s, at + 1, F.coalesce(F.get(starts, i + 1), F.size(s)) - at)
                return let(part, group_difference)

            return F.aggregate(F.transform(starts, one), F.lit(0), lambda n, d: n + d)

        return let(fresh, per_group)

    return let(F.struct(both.alias("s"), share.alias("g")), lambda x: difference(x["s"], x["g"]))


def group_difference(part: Column) -> Column:
    """Number of differing digests of a group. Adding the items of one side and
    taking those of the other away gives the difference of their sketches."""

    def signed(x: Column) -> tuple[Column, Column]:
        return x["key"], F.when(x["left"], long(1)).otherwise(long(-1))

    def attempt(done: Column, cells: Column) -> Column:
        return F.when(done.isNotNull(), done).otherwise(recovered(sketch(part, cells, signed), cells))

    def keys(left: bool) -> Column:
        return F.transform(F.filter(part, lambda x: x["left"] == left), lambda x: x["key"])

    sizes = F.array(*[long(c) for c in SIZES])
    exact = F.size(F.array_except(keys(True), keys(False))) + F.size(F.array_except(keys(False), keys(True)))
    return F.coalesce(F.aggregate(sizes, F.lit(None).cast("int"), attempt), exact)


def likeness(items: Column, cells: Column, other_items: Column, other_cells: Column) -> Column:
    """One minus the share of differing items, by the base sketches and, where
    they hold too much, by grouped ones."""
    base = recovered(subtracted(cells, other_cells), long(BASE_CELLS))
    differing = F.coalesce(base, grouped_difference(items, other_items))
    return 1 - differing / (F.size(items) + F.size(other_items))


def serialised(cells: Column) -> Column:
    """The sketch as text: count, digest and check of each cell in hexadecimal."""
    every = F.concat(*[cells[t] for t in TABLES])
    return F.array_join(F.transform(every, lambda c: F.concat_ws(":", F.hex(c["n"]), F.hex(c["key"]), F.hex(c["chk"]))), ",")


def followers(docs: DataFrame) -> DataFrame:
    """Stored (doc_id, hash, before_id, before_hash, want): every document and
    the one that it follows, which wants its first ``want`` signs."""
    own = stored(docs.select("doc_id", "hash", "n_chars").distinct(), "fp_ids")
    order = [F.col("doc_id").desc_nulls_last(), F.col("hash")]
    ranked = stored(distributed_row_number(own, order, "place"), "fp_order")
    count = ranked.agg(F.max("place")).first()[0] or 0
    after = (F.col("place") % max(count, 1)) + 1
    before = ranked.select(
        after.alias("place"), F.col("doc_id").alias("before_id"), F.col("hash").alias("before_hash"),
        F.floor(F.col("n_chars") / 3).cast("int").alias("want"),
    )
    return stored(ranked.drop("n_chars").join(before, "place").drop("place"), "fp_next")


def same(a: str, a_hash: str, b: str, b_hash: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b)) & (F.col(a_hash) == F.col(b_hash))


def edited_pairs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, text, edited, next_items) of every row of ``docs``. Both
    joins take the same columns, so the texts are shuffled once."""
    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    links = followers(rows.withColumn("n_chars", F.length("text"))).withColumnsRenamed({"doc_id": "id", "hash": "h"})
    sent = rows.join(links, same("doc_id", "hash", "id", "h")).select(
        "before_id", "before_hash", F.substring("text", F.lit(1), F.col("want")).alias("head"), items_of(F.col("text")).alias("next_items"),
    )
    # rows alike in id and text send the same; one of them is enough
    sent = sent.groupBy("before_id", "before_hash").agg(F.min(F.struct("head", "next_items")).alias("s"))
    sent = sent.select("before_id", "before_hash", "s.head", "s.next_items")
    joined = rows.join(sent, same("doc_id", "hash", "before_id", "before_hash"))
    n_chars = F.length("text")
    kept = F.substring("text", F.lit(1), (n_chars - F.floor(n_chars / 3)).cast("int"))
    return joined.select("doc_id", n_chars.cast("long").alias("n_chars"), "text", F.concat(kept, "head").alias("edited"), "next_items")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next of every document."""
    pairs = edited_pairs(docs)
    base = long(BASE_CELLS)
    rows = pairs.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), items_of(F.col("text")).alias("own"),
        items_of(F.col("edited")).alias("other"), "next_items",
    )
    rows = rows.select(
        "*", sketch(F.col("own"), base).alias("own_cells"), sketch(F.col("other"), base).alias("other_cells"),
        sketch(F.col("next_items"), base).alias("next_cells"),
    )
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", serialised(F.col("own_cells")).alias("fingerprint"),
        serialised(F.col("other_cells")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("own_cells"), F.col("other"), F.col("other_cells")).alias("near_edited"),
        likeness(F.col("own"), F.col("own_cells"), F.col("next_items"), F.col("next_cells")).alias("near_next"),
    )
