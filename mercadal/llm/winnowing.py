"""Benchmark decontamination by winnowing.

Of every run of seven consecutive 7-word grams the one with the least hash is
kept. A run covers 13 words, so a 13-word window that a document shares with a
benchmark item leaves the same fingerprint on both sides. Kept fingerprints are
joined and each hit is extended word by word to both sides; what reaches the
full window length marks its words. Items of fewer than 13 words are one window
of their own length: there every gram of that length is kept.

A fixed-size Bloom filter of the benchmark's fingerprints (2 MB whatever the
benchmark) thins the documents' side before the join; the join and the word by
word extension decide. Words that no window covers never mark anything.

Null texts have no words; items without words are ignored. Repeated rows and
ids are judged row by row, a null item id counts as the empty string. Extra
columns are not read. Empty tables give no rows or no hits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercadal.llm.tables import free_name, slices, stored, text_or_empty, utf8_values

WINDOW = 13
GRAM = 7
SHARE = 20  # contaminated: hits times SHARE reach the number of words
BLOOM_BITS = 24
_MASK64 = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
CANDIDATE = "struct<k:int,fp:long,pos:long,lead:int,words:array<string>>"
_CANDIDATE = pa.struct(
    [
        ("k", pa.int32()), ("fp", pa.int64()), ("pos", pa.int64()), ("lead", pa.int32()),
        ("words", pa.list_(pa.string())),
    ]
)


def _byte_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    word = np.zeros(256, dtype=bool)
    word[48:58] = word[97:123] = word[128:] = True  # after lower-casing
    values = np.random.default_rng(7).integers(0, _MASK64, 256, dtype=np.uint64, endpoint=True)
    return lower, word, values | np.uint64(1)


LOWER, IS_WORD, BYTE_VALUE = _byte_tables()
_powers: dict[str, np.ndarray] = {}


def _power_table(name: str, base: int, size: int) -> np.ndarray:
    if name not in _powers or len(_powers[name]) < size:
        table = np.full(size, base, dtype=np.uint64)
        table[:1] = 1
        _powers[name] = np.cumprod(table, dtype=np.uint64)
    return _powers[name][:size]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


class Words:
    """The words of some texts, found and hashed all at once."""

    def __init__(self, texts: list[bytes]):
        joined = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
        self.data = LOWER[joined]
        inside = np.zeros(len(joined) + 2, dtype=np.int8)
        inside[1:-1] = IS_WORD[self.data]
        steps = np.diff(inside)
        self.starts, self.ends = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
        firsts = np.cumsum([0] + [len(t) + 1 for t in texts])
        self.bounds = np.searchsorted(self.starts, firsts)  # first word of each text
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.bounds))
        size = len(joined) + 1
        sums = np.zeros(size, dtype=np.uint64)
        np.cumsum(BYTE_VALUE[self.data] * _power_table("up", _BASE, size)[:-1], out=sums[1:])
        spread = sums[self.ends] - sums[self.starts]
        self.hashes = mix(spread * _power_table("down", _BASE_INVERSE, size)[self.starts])

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k words from each word on; those that would run past the
        last word are left off."""
        count = max(len(self.hashes) - k + 1, 0)
        total = np.full(count, k, dtype=np.uint64)
        for j in range(k):
            total = total * np.uint64(0xD1342543DE82EF95) + self.hashes[j : j + count]
        return mix(total)

    def within(self, count: int, length: int) -> np.ndarray:
        """Whether ``length`` words from each of the first ``count`` words on
        belong to one text."""
        return self.doc[:count] == self.doc[length - 1 : length - 1 + count]

    def winnowed(self) -> tuple[np.ndarray, np.ndarray]:
        """(positions, hashes) of the grams kept for full windows."""
        grams, run = self.grams(GRAM), WINDOW - GRAM + 1
        count = len(grams) - run + 1
        if count <= 0:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
        least, at = grams[:count].copy(), np.arange(count)
        for j in range(1, run):
            ahead = grams[j : j + count]
            lower = ahead < least
            least[lower] = ahead[lower]
            at[lower] = np.flatnonzero(lower) + j
        kept = np.unique(at[self.within(count, WINDOW)])
        return kept, grams[kept]

    def every(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        grams = self.grams(k)
        kept = np.flatnonzero(self.within(len(grams), k)) if len(grams) else np.empty(0, dtype=np.int64)
        return kept, grams[kept]

    def candidate(self, k: int, at: int, fp: int) -> dict:
        """A fingerprint with the words around it that a window through it can hold."""
        d = self.doc[at]
        first, last = self.bounds[d], self.bounds[d + 1]
        side = WINDOW - k if k == GRAM else 0
        low, high = max(first, at - side), min(last, at + k + side)
        words = [self.data[self.starts[i] : self.ends[i]].tobytes().decode("utf-8") for i in range(low, high)]
        return {"k": k, "fp": fp, "pos": int(at - first), "lead": int(at - low), "words": words}


def bloom_places(fp: Column) -> list[Column]:
    mask = F.lit((1 << BLOOM_BITS) - 1)
    return [fp.bitwiseAND(mask), F.shiftright(fp, BLOOM_BITS).bitwiseAND(mask)]


def bloom_filter(marks: DataFrame) -> np.ndarray:
    """The benchmark's fingerprints as 2^24 bits: at most 2^18 words reach the driver."""
    places = marks.select(F.explode(F.array(*bloom_places(F.col("c.fp")))).alias("place"))
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    words = places.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    table = np.zeros(1 << (BLOOM_BITS - 6), dtype=np.int64)
    table[words["word"].to_numpy()] = words["bits"].to_numpy()
    return table.view(np.uint64)


def in_bloom(table: np.ndarray, fps: np.ndarray) -> np.ndarray:
    found = np.ones(len(fps), dtype=bool)
    for shift in (0, BLOOM_BITS):
        place = (fps >> np.uint64(shift)) & np.uint64((1 << BLOOM_BITS) - 1)
        found &= (table[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
    return found


def item_marks(benchmark: DataFrame) -> DataFrame:
    """Stored fingerprints of the benchmark: (item_id, n_words, c)."""

    def run(batches):
        for batch in batches:
            words = Words(utf8_values(batch.column(1)))
            counts = np.diff(words.bounds)
            marks: list[list[dict]] = [[] for _ in counts]
            for at, fp in zip(*words.winnowed(), strict=True):
                marks[words.doc[at]].append(words.candidate(GRAM, at, int(fp.view(np.int64))))
            for k in range(1, WINDOW):
                short = np.flatnonzero(counts == k)
                grams = words.grams(k) if len(short) else None
                for d in short:
                    at = words.bounds[d]
                    marks[d].append(words.candidate(k, at, int(grams[at].view(np.int64))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts), pa.array(marks, type=pa.list_(_CANDIDATE))],
                names=["item_id", "n_words", "marks"],
            )

    texts = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), text_or_empty())
    rows = texts.mapInArrow(run, f"item_id string, n_words long, marks array<{CANDIDATE}>")
    return stored(rows.select("item_id", "n_words", F.explode("marks").alias("c")), "item_marks")


def document_marks(texts: DataFrame, bloom: np.ndarray, short: list[int]) -> DataFrame:
    """(doc_id, hash, n_words, marks) of each row of (doc_id, hash, text): the
    kept fingerprints that the filter lets through."""
    shared = texts.sparkSession.sparkContext.broadcast(bloom)

    def run(batches):
        for batch in batches:
            texts = utf8_values(batch.column(2))
            for a, b in slices(texts):
                words = Words(texts[a:b])
                marks: list[list[dict]] = [[] for _ in range(b - a)]
                kinds = [(GRAM, *words.winnowed()), *((k, *words.every(k)) for k in short)]
                for k, at, fps in kinds:
                    hit = in_bloom(shared.value, fps)
                    for p, fp in zip(at[hit], fps[hit].view(np.int64), strict=True):
                        marks[words.doc[p]].append(words.candidate(k, p, int(fp)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        batch.column(1).slice(a, b - a),
                        pa.array(np.diff(words.bounds)),
                        pa.array(marks, type=pa.list_(_CANDIDATE)),
                    ],
                    names=["doc_id", "hash", "n_words", "marks"],
                )

    return texts.mapInArrow(run, f"doc_id long, hash long, n_words long, marks array<{CANDIDATE}>")


def extended(words: list[str], lead: int, other: list[str], other_lead: int, k: int) -> tuple[int, int] | None:
    """How far a hit reaches left and right of its gram; None if even that differs."""
    if words[lead : lead + k] != other[other_lead : other_lead + k]:
        return None
    left = 0
    while left < min(lead, other_lead) and words[lead - left - 1] == other[other_lead - left - 1]:
        left += 1
    right, i, j = 0, lead + k, other_lead + k
    while i + right < len(words) and j + right < len(other) and words[i + right] == other[j + right]:
        right += 1
    return left, right


def hit_spans(marks: DataFrame, items: DataFrame) -> DataFrame:
    """(row, first, last, item_id): words ``first`` to ``last`` (exclusive) of a
    row lie inside windows of the item."""
    d = marks.select("row", F.explode("marks").alias("d"))
    joined = d.join(items, (F.col("d.k") == F.col("c.k")) & (F.col("d.fp") == F.col("c.fp")))
    joined = joined.select(
        "row", "item_id", F.col("d.k").alias("k"), F.col("d.pos").alias("pos"),
        F.col("d.words").alias("words"), F.col("d.lead").alias("lead"),
        F.col("c.words").alias("other"), F.col("c.lead").alias("other_lead"),
    )

    def run(batches):
        for batch in batches:
            rows: list[tuple] = []
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for row, item, k, pos, words, lead, other, other_lead in zip(*columns, strict=True):
                reach = extended(words, lead, other, other_lead, k)
                # a gram shorter than the window length is a short item as a whole
                if reach and (k != GRAM or len(other) == GRAM or sum(reach) + k >= WINDOW):
                    rows.append((row, pos - reach[0], pos + k + reach[1], item))
            got = list(zip(*rows, strict=True)) or [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, type=t) for v, t in zip(got, kinds, strict=True)],
                names=["row", "first", "last", "item_id"],
            )

    return joined.mapInArrow(run, "row long, first long, last long, item_id string")


def covered(spans: Column) -> Column:
    """Number of positions in the union of (first, last) spans."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("reach"))

    def add(state: Column, span: Column) -> Column:
        fresh = F.greatest(span["last"] - F.greatest(span["first"], state["reach"]), F.lit(0).cast("long"))
        reach = F.greatest(state["reach"], span["last"])
        return F.struct((state["n"] + fresh).alias("n"), reach.alias("reach"))

    return F.aggregate(F.array_sort(spans), start, add)["n"]


def judged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, hash (of the text), n_words, n_hit, n_items, items_sha256 and
    contaminated of every document row."""
    items = item_marks(benchmark)
    short = [r[0] for r in items.where(F.col("n_words") < WINDOW).select("n_words").distinct().collect()]
    text = text_or_empty()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    marks = document_marks(texts, bloom_filter(items), sorted(short))
    marks = stored(marks.withColumn("row", F.monotonically_increasing_id()), "doc_marks")
    hits = hit_spans(marks.where(F.size("marks") > 0), items).groupBy("row").agg(
        covered(F.collect_set(F.struct("first", "last"))).alias("n_hit"),
        F.array_sort(F.collect_set("item_id")).alias("items"),
    )
    rows = marks.select("row", "doc_id", "hash", "n_words").join(hits, "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    items_found = F.coalesce("items", F.array().cast("array<string>"))
    return rows.select(
        "doc_id", "hash", "n_words", n_hit.alias("n_hit"),
        F.size(items_found).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items_found), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * SHARE >= F.col("n_words"))).alias("contaminated"),
    )


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return judged(docs, benchmark).drop("hash")


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    own, other = free_name(docs, "_id"), free_name(docs, "_hash")
    bad = judged(docs, benchmark).where("contaminated").select(F.col("doc_id").alias(own), F.col("hash").alias(other))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(own)) & (F.xxhash64(text_or_empty()) == F.col(other))
    return docs.join(bad.distinct(), same, "left_anti")
