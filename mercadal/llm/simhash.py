"""Near-duplicate groups by SimHash, compared in bit planes.

Fingerprints within three bits of each other agree on at least two of five bit
blocks, so ten tables, one per pair of blocks, bring every such pair together.
Within a table the rows lie sorted by key, and blocks of them are compared in
bit-sliced form: plane b holds bit b of 64 fingerprints per machine word, and
the distances of 64 candidates are counted at once by carry-save counters of
three bits. A query leaves its block once all its distances exceed the radius.

Equal fingerprints are one node, whatever the number of documents. A key that
holds more than ``CHUNK`` nodes is cut in chunks, and every pair of chunks is a
task's work of its own. Tasks report spanning links only. Components of the
links follow by alternating star contraction, each round stored.

Null texts count as empty; texts without words have fingerprint zero and form
one group. Repeated rows, null ids (never the smallest id) and extra columns are
fine; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from mercadal.llm.tables import free_name, stored, text_or_empty, utf8_values

SEED = 42
SHINGLE = 3
RADIUS = 3
CHUNK = 8192
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))  # first bit, width
QUERIES = 256
PENDING = 1 << 16


def fingerprint_of(text: bytes) -> int:
    """64-bit SimHash of the three-word shingles of a text."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.r_[0, ends[:-1]]
    if len(words) < SHINGLE:
        shingles = [joined]
    else:
        # shingle i runs from word i to the end of word i + 2
        bounds = zip(starts[: len(words) - SHINGLE + 1].tolist(), (ends[SHINGLE - 1 :] - 1).tolist(), strict=True)
        shingles = [joined[a:b] for a, b in bounds]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype="<u8", count=len(shingles))
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 14):
        part = hashes[start : start + (1 << 14)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(majority.view("<u8")[0])


@F.arrow_udf(LongType())
def fingerprint(texts: pa.Array) -> pa.Array:
    """The fingerprint as a signed 64-bit number."""
    values = np.array([fingerprint_of(t) for t in utf8_values(texts)], dtype=np.uint64)
    return pa.array(values.view(np.int64))


def bits_of(values: np.ndarray) -> np.ndarray:
    """64 x n matrix of the bits of n fingerprints."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)
    return np.unpackbits(raw, axis=1, bitorder="little").T


def planes_of(bits: np.ndarray) -> np.ndarray:
    """Vertical form: row b holds bit b of all fingerprints, 64 to a word."""
    n = bits.shape[1]
    padded = np.zeros((64, -(-n // 64) * 64), dtype=np.uint8)
    padded[:, :n] = bits
    return np.packbits(padded, axis=1, bitorder="little").view("<u8")


def close_pairs(queries: np.ndarray, candidates: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (query, candidate) at distance ``radius`` (at most 3) or less."""
    query_bits = bits_of(queries)
    planes = planes_of(bits_of(candidates))
    alive = np.arange(len(queries))
    shape = (len(queries), planes.shape[1])
    ones, twos, over = (np.zeros(shape, dtype=np.uint64) for _ in range(3))
    masks = (-(query_bits.astype(np.int64))).view(np.uint64)
    for b in range(64):
        differs = planes[b] ^ masks[b, alive][:, None]
        carry = ones & differs
        ones ^= differs
        over |= twos & carry
        twos ^= carry
        if b % 8 == 7 and b < 63:
            going = (~over).any(axis=1)
            if not going.any():
                return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
            if going.sum() < 0.75 * len(alive):
                alive, ones, twos, over = alive[going], ones[going], twos[going], over[going]
    # counter value is twos,ones once ``over`` (four or more) is clear
    near = ~over
    if radius < 3:
        near &= ~(twos & ones)
    if radius < 2:
        near &= ~twos
    if radius < 1:
        near &= ~ones
    found = np.unpackbits(near.view(np.uint8), axis=1, bitorder="little")[:, : len(candidates)]
    q, c = np.nonzero(found)
    return alive[q], c


def merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Joins the classes of each pair; a class is named by its least index."""
    while True:
        la, lb = labels[a], labels[b]
        apart = la != lb
        if not apart.any():
            return labels
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        parent = np.arange(len(labels))
        np.minimum.at(parent, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
        labels = parent[labels]


def spanning_links(groups: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (larger, smaller value) of the close pairs among sorted
    rows. Blocks of rows meet all rows up to the end of their last group; a
    close pair from two groups of one block is a link just as well."""
    n = len(values)
    last = np.searchsorted(groups, groups, side="right")
    labels = np.arange(n)
    for start in range(0, n, QUERIES):
        stop = min(start + QUERIES, n)
        end = int(last[stop - 1])
        if end - start < 2:
            continue
        for at in range(start, end, CHUNK):
            q, c = close_pairs(values[start:stop], values[at : min(at + CHUNK, end)])
            labels = merge_labels(labels, q + start, c + at)
    moved = np.flatnonzero(labels != np.arange(n))
    x, y = values[moved].view(np.int64), values[labels[moved]].view(np.int64)
    keep = x != y
    return np.maximum(x, y)[keep], np.minimum(x, y)[keep]


def block_tables(nodes: DataFrame) -> DataFrame:
    """Each fingerprint once per pair of blocks: (fp, tab, key)."""

    def block(which: int) -> Column:
        first, width = BLOCKS[which]
        return F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << width) - 1))

    entries = [
        F.struct(F.lit(t).alias("tab"), (block(i) * (1 << 13) + block(j)).alias("key"))
        for t, (i, j) in enumerate(combinations(range(len(BLOCKS)), 2))
    ]
    return nodes.select("fp", F.explode(F.array(*entries)).alias("e")).select("fp", "e.tab", "e.key")


def close_links(nodes: DataFrame) -> DataFrame:
    """Stored spanning links (a > b) that connect the same fingerprints as all
    pairs within the radius."""
    rows = block_tables(nodes)
    large = rows.groupBy("tab", "key").count().where(F.col("count") > CHUNK)
    large = stored(large.select("tab", "key", F.ceil(F.col("count") / CHUNK).cast("int").alias("n")), "hot")
    rows = rows.join(large, ["tab", "key"], "left").withColumn("n", F.coalesce("n", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")
    others = F.transform(
        F.sequence(F.lit(0), F.col("n") - 1),
        lambda k: F.struct(F.least(own, k).alias("i"), F.greatest(own, k).alias("j")),
    )
    cells = rows.select("fp", "tab", "key", F.explode(others).alias("p")).select("tab", "key", "p.i", "p.j", "fp")
    by = ["tab", "key", "i", "j"]

    def run(batches):
        kept = None
        for batch in batches:
            part = [batch.column(k).to_numpy() for k in range(5)]
            kept = part if kept is None else [np.concatenate(x) for x in zip(kept, part, strict=True)]
            if len(kept[0]) < PENDING:
                continue
            ids = group_numbers(kept)
            done = int(np.searchsorted(ids, ids[-1]))  # the last group may go on
            if done:
                yield links(ids[:done], kept[4][:done])
                kept = [x[done:] for x in kept]
        if kept is not None and len(kept[0]):
            yield links(group_numbers(kept), kept[4])

    def group_numbers(columns):
        new = np.zeros(len(columns[0]), dtype=bool)
        for c in columns[:4]:
            new[1:] |= c[1:] != c[:-1]
        return np.cumsum(new)

    def links(ids, values):
        a, b = spanning_links(ids, values.view(np.uint64))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    dealt = cells.repartition(*by).sortWithinPartitions(*by)
    return stored(dealt.mapInArrow(run, "a long, b long").distinct(), "links")


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node, root being the least node reachable.

    Alternates two contractions until nothing changes: each node hands its
    larger neighbours to its least neighbour, then all its smaller ones.
    """

    def trace(df: DataFrame) -> tuple:
        total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        return tuple(df.agg(F.count(F.lit(1)), total).first())

    def least(pairs: DataFrame, with_self: bool) -> DataFrame:
        m = F.min("v")
        return pairs.groupBy("u").agg((F.least(m, F.col("u")) if with_self else m).alias("m"))

    edges, before = links, None
    while True:
        now = trace(edges)
        if now == before or not now[0]:
            break
        before = now
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        large = both.where("v > u").join(least(both, True), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.distinct(), "large")
        low = least(large, False)
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        edges = stored(small.distinct(), "small")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def fingerprint_components(prints: DataFrame) -> DataFrame:
    """(fp, component_id) for each fingerprint of stored (doc_id, fp) rows."""
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(close_links(nodes))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    best = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(best, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id of every document."""
    prints = docs.select(F.col("doc_id").cast("long").alias("doc_id"), fingerprint(text_or_empty()).alias("fp"))
    prints = stored(prints, "prints")
    grouped = prints.join(fingerprint_components(prints), "fp")
    return grouped.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_each(docs: DataFrame) -> DataFrame:
    """One document of each group: the one with the smallest id. Rows that
    repeat that id are kept once (the least text); a group without any id keeps
    its least text."""
    row, fp = free_name(docs, "_row"), free_name(docs, "_fp")
    marked = docs.withColumn(row, F.monotonically_increasing_id()).withColumn(fp, fingerprint(text_or_empty()))
    marked = stored(marked, "marked")
    prints = marked.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(fp).alias("fp"), F.col(row).alias("row"))
    grouped = prints.join(fingerprint_components(prints.select("doc_id", "fp")), "fp")
    root = F.coalesce("component_id", "doc_id")
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "row")
    # a group is named by its component id, one without ids by its fingerprint
    kept = grouped.groupBy(root.alias("c"), F.when(root.isNull(), F.col("fp")).alias("f")).agg(F.min(place).alias("p"))
    kept = kept.select(F.col("p.row").alias(row))
    return marked.join(kept, row, "left_semi").select(*docs.columns)
