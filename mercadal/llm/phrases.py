"""Collocations by Toivonen mining.

A phrase can only be frequent if the phrases without its first and without its
last word are. A sample of the documents (one in ``SAMPLE_ONE_IN``, by hash,
whole texts) is mined with a lowered bound; its frequent phrases are the
proposals. The pass over all documents counts every word, and every longer
phrase whose two parts are proposals: that is the proposals and their negative
border, counted exactly. Where a counted phrase proves frequent without having
been proposed, the border has failed. One more pass counts all that such phrases
newly allow: it takes every phrase that it counts for frequent, so that longer
ones around it are counted along with it. A phrase of that pass holds one that
failed, so only the words around those are looked at. The result does not depend
on the sample. The sample itself is mined a length at a time.

Which phrases are proposed is told to the tasks by Bloom filters, one for each
round of the sample and one for the failures, sized by the number of their phrases (``2**MAX_BITS`` bits at most). A
phrase that a filter takes for a proposal by mistake is counted without need;
counts themselves are kept by the phrases, never by their hashes.

Null texts are empty, a null lang is ``und``. Repeated rows and ids count as
often as they occur; null ids and extra columns do not matter; empty tables and
texts without words give no rows. A text of any length is worked on whole, about
``SLICE`` bytes of texts at a time (a longer text alone).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from mercadal.llm.tables import packed, runs_of, slices, stored, text_or_empty, unpacked, utf8_values

LEAST = 30
LONGEST = 4
TOP = 2000
COVERED = 80  # a phrase goes if COVERED % of its occurrences lie in a longer one
SAMPLE_ONE_IN = 8
SAMPLE_LEAST = 2  # about half of LEAST / SAMPLE_ONE_IN
SLICE = 4 << 20
BUCKET_TEXT = 4 << 20  # bytes of text behind one group of phrases
MAX_BITS = 30
SALTS = 64
UNKNOWN = "und"
COUNTS = "lang string, phrase string, n long"
SPACE = pa.scalar(b" ", pa.large_binary())


def _byte_table() -> bytes:
    table = bytearray(range(256))
    for c in range(ord("A"), ord("Z") + 1):
        table[c] = c + 32
    for c in b".,;:!?\x0a\x0b\x0c\x0d":
        table[c] = ord("\n")
    table[ord("\t")] = ord(" ")
    return bytes(table)


BYTES = _byte_table()


# ---------------------------------------------------------------- Bloom filters
def word_hashes(words: list[bytes], seed: int) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), dtype=np.uint64, count=len(words))


def follow(head: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase and one more word."""
    h = (head ^ (head >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + word
    return (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)


def seed_of(lang: str) -> int:
    return xxhash.xxh32_intdigest(lang.encode())


def phrase_hash(lang: str, phrase: str) -> int:
    hashes = word_hashes(phrase.encode().split(b" "), seed_of(lang))
    head = hashes[:1]
    for i in range(1, len(hashes)):
        head = follow(head, hashes[i : i + 1])
    return int(head[0])


class Filter:
    """A bit table; two bits tell of each phrase."""

    def __init__(self, bits: int, table: np.ndarray):
        self.bits, self.table = bits, table

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), dtype=bool)
        for place in places(hashes, self.bits):
            found &= (self.table[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
        return found


def places(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    mask = np.uint64((1 << bits) - 1)
    return [hashes & mask, (hashes >> np.uint64(64 - bits)) & mask]


def in_any(filters: list[Filter], hashes: np.ndarray) -> np.ndarray:
    found = np.zeros(len(hashes), dtype=bool)
    for f in filters:
        found |= f.has(hashes)
    return found


def filter_of(phrases: DataFrame, count: int) -> Filter:
    """The filter of stored (lang, phrase) rows; it is put together by the tasks
    and reaches the driver as its non-empty 64-bit words."""
    bits = min(max(16 * count, 1 << 16).bit_length(), MAX_BITS)

    def run(batches):
        for batch in batches:
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            hashes = np.fromiter((phrase_hash(*p) for p in pairs), dtype=np.uint64, count=batch.num_rows)
            spots = np.concatenate(places(hashes, bits))
            bit = (np.uint64(1) << (spots & np.uint64(63))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((spots >> np.uint64(6)).view(np.int64)), pa.array(bit)], names=["word", "bit"])

    marks = phrases.select("lang", "phrase").mapInArrow(run, "word long, bit long")
    found = marks.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(1 << (bits - 6), dtype=np.int64)
    table[found["word"].to_numpy()] = found["bits"].to_numpy()
    return Filter(bits, table.view(np.uint64))


# --------------------------------------------------------------------- counting
def words_of(texts: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """The words of some texts as numbers, with -1 between pieces, and the
    distinct words."""
    joined = b"\n".join([*texts, b""]).translate(BYTES).replace(b"\n", b" \n ")
    tokens = pc.split_pattern(pa.array([joined], pa.large_binary()), b" ").flatten().dictionary_encode()
    words = tokens.dictionary.to_pylist()
    number = np.arange(len(words))
    gap = words.index(b"\n")
    blank = words.index(b"") if b"" in words else -1
    number[gap] = -1
    ids = tokens.indices.to_numpy(zero_copy_only=False)
    return number[ids[ids != blank]], words


class Counted:
    """Distinct phrases of one length with their counts; ``words`` holds their
    word numbers, a row for each place in the phrase."""

    def __init__(self, ids: np.ndarray, at: np.ndarray, length: int, size: int):
        width = max(int(size).bit_length(), 1)
        keys, used, ranks = ids[at].astype(np.int64), width, []
        for j in range(1, length):
            if used + width > 62:  # numbers of the phrases so far, as these fit
                heads, keys = np.unique(keys, return_inverse=True)
                ranks.append((j, heads))
                used = int(len(heads)).bit_length()
            keys = keys << width | ids[at + j]
            used += width
        keys, self.count = np.unique(keys, return_counts=True)
        self.words: list[np.ndarray] = []
        for j in range(length - 1, -1, -1):
            if ranks and ranks[-1][0] == j + 1:
                keys = ranks.pop()[1][keys]
            self.words.insert(0, keys & ((1 << width) - 1) if j else keys)
            keys = keys >> width


def around(ids: np.ndarray, hashes: np.ndarray, failed: Filter) -> np.ndarray:
    """The words from which a phrase can be made that holds one of ``failed``, in
    their order, with -1 between their runs."""
    near = np.zeros(len(ids) + 2 * LONGEST, dtype=bool)  # place p stands at p + LONGEST
    word, live = hashes[ids], ids >= 0
    head, hit = word, failed.has(hashes)[ids] & live
    for length in range(1, LONGEST):
        if length > 1:
            live = live[:-1] & live[1:]
            head = follow(head[: len(live)], word[length - 1 :])
            hit = live & failed.has(head)
        at = np.flatnonzero(hit) + LONGEST
        for shift in range(length - LONGEST, LONGEST):
            near[at + shift] = True
    near = near[LONGEST : LONGEST + len(ids)] & (ids >= 0)
    at = np.flatnonzero(near)
    if not len(at):
        return ids[:0]
    return np.insert(ids[at], np.flatnonzero(np.diff(at) > 1) + 1, -1)


def counted_phrases(
    ids: np.ndarray, hashes: np.ndarray, known: list[Filter], done: list[Filter] | None, ahead: bool = False
) -> Iterator[Counted]:
    """The phrases to be counted: both parts known, unless they were so in an
    earlier pass. ``done`` is None in the first pass, which counts the words too.
    With ``ahead`` a phrase that is counted is known to the longer ones."""
    if not len(hashes):
        return
    if ahead:
        ids = around(ids, hashes, known[-1])
    is_word = ids >= 0
    if done is None:
        yield Counted(ids, np.flatnonzero(is_word), 1, len(hashes))
    word = hashes[ids]
    head, live, old = word, in_any(known, hashes)[ids] & is_word, in_any(done or [], hashes)[ids] & is_word
    for length in range(2, LONGEST + 1):
        # a phrase from each place on that has both parts
        live = live[:-1] & live[1:]
        old = old[:-1] & old[1:]
        wanted = np.flatnonzero(live & ~old)
        if len(wanted):
            yield Counted(ids, wanted, length, len(hashes))
        at = np.flatnonzero(live)
        if not len(at):
            return
        head = head[: len(live)].copy()
        head[at] = follow(head[at], word[at + length - 1])
        live[at] = in_any(known, head[at]) | (ahead & ~old[at])
        old[at] &= in_any(done or [], head[at])


ROWS = {"lang": pa.string(), "bucket": pa.int64(), "data": pa.binary()}


def phrase_hashes(words: list[np.ndarray], hashes: np.ndarray) -> np.ndarray:
    head = hashes[words[0]]
    for w in words[1:]:
        head = follow(head, hashes[w])
    return head


def count_texts(
    lang: str, texts: list[bytes], known: list[Filter], done: list[Filter] | None, ahead: bool, buckets: int
) -> pa.RecordBatch:
    """Counts of some texts, dealt by the hash of the phrase: per bucket lengths
    and bytes of the phrases and their counts. Bucket -1 has the number of words."""
    ids, words = words_of(texts)
    hashes = word_hashes(words, seed_of(lang))
    dictionary = pa.array(words, pa.large_binary())
    phrases, number, bucket = [], [], []
    for c in counted_phrases(ids, hashes, known, done, ahead):
        parts = [dictionary.take(pa.array(w)) for w in c.words]
        phrases.append(pc.binary_join_element_wise(*parts, SPACE) if len(parts) > 1 else parts[0])
        number.append(c.count)
        bucket.append((phrase_hashes(c.words, hashes) >> np.uint64(16)) % np.uint64(buckets))
    out = {"lang": [], "bucket": [], "data": []}
    if done is None:
        out = {"lang": [lang], "bucket": [-1], "data": [packed(np.array([(ids >= 0).sum()]))]}
    if phrases:
        home = np.concatenate(bucket).astype(np.int64)
        order = np.argsort(home, kind="stable")
        count, home = np.concatenate(number)[order], home[order]
        text = pa.concat_arrays(phrases).take(pa.array(order))
        ends = np.frombuffer(text.buffers()[1], dtype=np.int64, count=len(text) + 1)
        data = np.frombuffer(text.buffers()[2], dtype=np.uint8)
        for a, b in runs_of(home):
            out["lang"].append(lang)
            out["bucket"].append(int(home[a]))
            sizes = np.diff(ends[a : b + 1])
            out["data"].append(packed(sizes.astype(np.uint32), data[ends[a] : ends[b]], count[a:b].astype(np.uint32)))
    return pa.RecordBatch.from_arrays([pa.array(out[k], t) for k, t in ROWS.items()], names=list(ROWS))


def add_counts(least: int):
    """Phrases of a bucket with ``least`` occurrences or more; words in bucket -1."""

    def run(group: pa.Table) -> pa.Table:
        lang, parts = group["lang"][0].as_py(), [unpacked(raw) for raw in group["data"].to_pylist()]
        if group["bucket"][0].as_py() < 0:
            return pa.table({"lang": [lang], "phrase": pa.array([None], pa.string()), "n": [sum(int(p[0][0]) for p in parts)]})
        sizes, data, count = (np.concatenate(x) for x in zip(*parts, strict=True))
        ends = np.append(0, np.cumsum(sizes, dtype=np.int64))
        phrases = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(data)])
        summed = pa.table({"phrase": phrases, "n": count.astype(np.int64)}).group_by("phrase").aggregate([("n", "sum")])
        summed = summed.filter(pc.greater_equal(summed["n_sum"], least))
        return pa.table(
            {"lang": pa.array([lang] * len(summed), pa.string()), "phrase": summed["phrase"].cast(pa.string()), "n": summed["n_sum"]}
        )

    return run


def counts(
    docs: DataFrame, known: list[Filter], done: list[Filter] | None, least: int, buckets: int, ahead: bool = False
) -> DataFrame:
    """(lang, phrase, n) of the phrases with ``least`` occurrences in ``docs``; in
    the first pass also, with a null phrase, the number of words."""
    shared = docs.sparkSession.sparkContext.broadcast((known, done, ahead))

    def run(batches):
        held: dict[str, list[bytes]] = {}
        size = 0
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), utf8_values(batch.column(1))
            for start, stop in slices(texts, SLICE):
                for lang, text in zip(langs[start:stop], texts[start:stop], strict=True):
                    held.setdefault(lang, []).append(text)
                    size += len(text)
                if size >= SLICE:
                    for lang, some in held.items():
                        yield count_texts(lang, some, *shared.value, buckets)
                    held, size = {}, 0
        for lang, some in held.items():
            yield count_texts(lang, some, *shared.value, buckets)

    rows = docs.select("lang", "text").mapInArrow(run, "lang string, bucket long, data binary")
    return rows.groupBy("lang", "bucket").applyInArrow(add_counts(least), COUNTS)


def length_of(phrase: Column) -> Column:
    return F.length(phrase) - F.length(F.replace(phrase, F.lit(" "))) + 1


def not_known(known: list[Filter]) -> Column:
    @F.arrow_udf("boolean")
    def told(langs: pa.Array, phrases: pa.Array) -> pa.Array:
        pairs = zip(langs.to_pylist(), phrases.to_pylist(), strict=True)
        hashes = np.fromiter((phrase_hash(*p) for p in pairs), dtype=np.uint64, count=len(langs))
        return pa.array(~in_any(known, hashes))

    return told("lang", "phrase")


def closed(docs: DataFrame, least: int, known: list[Filter], buckets: int) -> tuple[DataFrame, list[Filter]]:
    """All phrases with ``least`` occurrences or more, counted exactly, whatever
    was known at the start; and the filters of all that can be extended.

    From proposals on, two passes do: the second one counts ahead. From nothing
    there is a pass for each length."""
    found, done, ahead = None, None, bool(known)
    while True:
        frequent = stored(counts(docs, known, done, least, buckets, ahead and done is not None), "phrases")
        found = frequent if found is None else found.unionByName(frequent)
        if ahead and done is not None:
            return found, known
        failed = frequent.where(F.col("phrase").isNotNull() & (length_of(F.col("phrase")) < LONGEST))
        failed = stored(failed.where(not_known(known)) if known else failed, "failed")
        count = failed.count()
        if not count:
            return found, known
        done, known = known, [*known, filter_of(failed, count)]


# ---------------------------------------------------------------------- scoring
def part_of(phrase: Column, start: int | Column, count: Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), start, count), " ")


def scored(frequent: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, n, score of the candidates that no longer one covers."""
    phrase, words = F.col("phrase"), length_of(F.col("phrase"))
    candidates = frequent.where(words >= 2).withColumn("words", words)
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.select(
        "lang", "phrase", F.col("n").alias("a"), "k",
        part_of(phrase, 1, F.col("k")).alias("left"), part_of(phrase, F.col("k") + 1, F.col("words")).alias("right"),
    )
    for side, name in (("left", "l"), ("right", "r")):
        known = frequent.select("lang", F.col("phrase").alias(side), F.col("n").alias(name))
        cuts = cuts.join(known, ["lang", side])
    wide = [F.col(c).cast("decimal(20,0)") for c in ("a", "l", "r")]
    score = F.floor(F.lit(2_000_000).cast("decimal(8,0)") * wide[0] / (wide[1] + wide[2])).cast("long")
    # quotients are checked in whole numbers: a decimal quotient may be rounded up
    over = score.cast("decimal(20,0)") * (wide[1] + wide[2]) > F.lit(2_000_000).cast("decimal(8,0)") * wide[0]
    cuts = cuts.withColumn("score", F.when(over, score - 1).otherwise(score))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("c"))
    best = best.select("lang", "phrase", "c.a", "c.l", "c.r", "c.score")

    inner = candidates.where("words > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    inner = inner.withColumn("start", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    inner = inner.select("lang", part_of(phrase, F.col("start"), F.col("size")).alias("phrase"), "n")
    longer = inner.groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    covered = F.col("longer").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * COVERED
    kept = best.join(longer, ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False))).drop("longer")
    return kept.join(totals, "lang")


def ranked(rows: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each lang: those of ``SALTS`` parts of it first, so
    that no task ranks all of a lang."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    part = F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))
    some = rows.withColumn("salt", salt).withColumn("rank", part).where(F.col("rank") <= top)
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    number = F.col("rank").cast("long").alias("rank")
    return some.where(F.col("rank") <= top).select("lang", number, "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The best phrases of two to four words of each language."""
    texts = docs.select(
        F.col("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), text_or_empty().alias("text")
    )
    total = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = total // BUCKET_TEXT + 1
    sample = texts.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(SAMPLE_ONE_IN)) == 0)
    _, proposed = closed(sample, min(least, SAMPLE_LEAST), [], buckets)
    found, _ = closed(texts, least, proposed, buckets)
    totals = found.where(F.col("phrase").isNull()).select("lang", "n")
    return ranked(scored(found.where(F.col("phrase").isNotNull()), totals), top)


SQL = """
WITH docs AS (
    SELECT coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents),
pieces AS (
    SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM docs),
words AS (
    SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
starts AS (
    SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
    FROM words, (VALUES (1), (2), (3), (4)) AS lengths(k) WHERE len(w) >= k),
counted AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS n
    FROM starts GROUP BY ALL),
totals AS (
    SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM counted WHERE k = 1 GROUP BY lang),
candidates AS (
    SELECT lang, k, phrase, string_split(phrase, ' ') AS w, n AS a FROM counted WHERE k >= 2 AND n >= 30),
cuts AS (
    SELECT lang, k, phrase, w, a, unnest(range(1, k)) AS cut FROM candidates),
scores AS (
    SELECT c.lang, c.phrase, c.a, c.cut, h.n AS l, t.n AS r,
           CAST((2000000::HUGEINT * c.a) // (h.n::HUGEINT + t.n) AS BIGINT) AS score
    FROM cuts c
    JOIN counted h ON h.lang = c.lang AND h.phrase = array_to_string(c.w[1:c.cut], ' ')
    JOIN counted t ON t.lang = c.lang AND t.phrase = array_to_string(c.w[c.cut + 1:c.k], ' ')),
best AS (
    SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
sizes AS (
    SELECT lang, w, k, a, unnest(range(2, k)) AS size FROM candidates WHERE k > 2),
places AS (
    SELECT lang, w, a, size, unnest(range(1, k - size + 2)) AS i FROM sizes),
longer AS (
    SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(a) AS most FROM places GROUP BY ALL),
kept AS (
    SELECT b.lang, b.phrase, b.a, b.l, b.r, b.score
    FROM best b LEFT JOIN longer g ON g.lang = b.lang AND g.phrase = b.phrase
    WHERE g.most IS NULL OR 100::HUGEINT * g.most < 80::HUGEINT * b.a),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT p.lang, p.rank, p.phrase, p.a, p.l, p.r, t.n, p.score
FROM placed p JOIN totals t ON t.lang = p.lang WHERE p.rank <= 2000
"""
