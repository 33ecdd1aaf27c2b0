"""Personal data and the terms that give it away.

Base spans follow four fixed patterns. Around them the method looks for terms
that disclose an entity (one address, number or card): with documents as units,
the corpus gives the information of an entity, ``ln(N / n_e)``, and how much of
it a term carries, the pointwise mutual information ``ln(N * n_te / (n_t * n_e))``.
Their ratio is the disclosed share. N, n_t and n_e count all documents with words,
with the term and with the entity; n_te those where the two meet, that is, stand
at most 32 tokens apart, across line ends. A term that meets the entity at two
different places (lines of its own and of the entity, or documents) and discloses
85 % of it is generalised, from 95 % on removed, throughout every document that
holds the entity.

Only DataFrame functions are used. No pattern crosses a line end, so lines are
the unit of work, and offsets come from running sums over matches and gaps.
Null texts count as empty, documents without findings get zero counts and empty
lists, repeated rows are judged one by one, extra columns are kept or not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercadal.llm.tables import free_name, stored, text_or_empty

# The four kinds in the order of the output. The patterns match
# what `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+` and its fellows match, but never go
# back over what they have read: a run of name characters is entered at its
# start or where the last match ended, and repeats are possessive.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# every text with a base span has one of these
SUSPECT = r"@[A-Za-z0-9-]+\.|[0-9]\.[0-9]+\.[0-9]+\.[0-9]|(?:[0-9][ -]?){12}[0-9]|\+[0-9][ ().0-9-]"
TOKEN = r"[\p{L}\p{N}]+"
NEAR = 32  # tokens
LEAST_LETTERS = 3
GENERALISE, REMOVE = 0.85, 0.95
TERM = "term"
KINDS = [*PATTERNS, TERM]


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn_ok(number: Column) -> Column:
    """13 to 19 digits whose check sum is divisible by ten."""
    n = F.length(number)

    def part(i: Column) -> Column:
        d = F.substring(number, n - i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda s, i: s + part(i))
    return n.between(13, 19) & (F.when(n.between(13, 19), total % 10) == 0)


def valid(kind: Column, value: Column) -> Column:
    octets = F.forall(
        F.split(value, r"\."), lambda p: F.coalesce(p.try_cast("bigint"), F.lit(256)) <= 255
    )
    return (
        F.when(kind == "ip", octets)
        .when(kind == "card", luhn_ok(digits(value)))
        .when(kind == "phone", F.length(digits(value)).between(9, 15))
        .otherwise(True)
    )


def located(rows: DataFrame, by: list[str], found: Column, gaps: Column) -> DataFrame:
    """One row per match with ``start`` and ``end`` in code points: running sums
    of the lengths of the matches and of the gaps before them."""
    pairs = F.arrays_zip(found.alias("value"), F.slice(gaps, F.lit(1), F.size(found)).alias("gap"))
    each = rows.where(F.size(found) > 0).select(*by, F.posexplode(pairs).alias("i", "m"))
    each = each.select(*by, "i", F.col("m.value").alias("value"), (F.length("m.value") + F.length("m.gap")).alias("n"))
    so_far = Window.partitionBy(*[c for c in by if c in ("row", "line_no", "kind")]).orderBy("i")
    end = F.sum("n").over(so_far.rowsBetween(Window.unboundedPreceding, 0))
    return each.withColumn("end", end).withColumn("start", F.col("end") - F.length("value")).drop("n")


def lines_of(suspects: DataFrame) -> DataFrame:
    """(row, text_hash, line_no, line_start, line) of stored (row, text) rows."""
    each = suspects.where(F.col("text").isNotNull()).select(
        "row", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line")
    )
    before = Window.partitionBy("row").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("line") + 1).over(before), F.lit(0))
    return each.select("row", "text_hash", "line_no", start.alias("line_start"), "line")


def base_spans(lines: DataFrame) -> DataFrame:
    """(row, line_no, line_start, kind, value, start, end), offsets in the line."""
    kinds = [
        F.struct(
            F.lit(kind).alias("kind"),
            F.regexp_extract_all("line", F.lit(pattern), 0).alias("found"),
            F.split("line", pattern, -1).alias("gaps"),
        )
        for kind, pattern in PATTERNS.items()
    ]
    tried = lines.where(F.col("line").rlike("[@0-9]"))
    each = tried.select("row", "line_no", "line_start", F.explode(F.array(*kinds)).alias("k"))
    each = each.select("row", "line_no", "line_start", "k.kind", "k.found", "k.gaps")
    spans = located(each, ["row", "line_no", "line_start", "kind"], F.col("found"), F.col("gaps"))
    return spans.where(valid(F.col("kind"), F.col("value"))).drop("i")


def corpus_counts(texts: DataFrame) -> DataFrame:
    """(term, n): in how many documents of the corpus a term stands; the empty
    term counts the documents that have words."""
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")
    words = texts.select(F.array_distinct(words).alias("words")).where(F.size("words") > 0)
    terms = words.select(F.explode(F.concat(F.array(F.lit("")), "words")).alias("term"))
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def marked_tokens(lines: DataFrame, spans: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Terms (row, line_no, line_start, term, start, end, at, place) outside the spans
    and entities (row, entity, first, last, place), for documents that have spans.
    ``at``, ``first`` and ``last`` number the tokens of the document, ``place``
    stands for the text and the line."""
    hit = lines.join(spans.select("row").distinct(), "row", "left_semi")
    found = F.regexp_extract_all("line", F.lit(TOKEN), 0)
    before = Window.partitionBy("row").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    hit = hit.withColumn("place", F.xxhash64("text_hash", "line"))
    hit = hit.withColumn("so_far", F.coalesce(F.sum(F.size(found)).over(before), F.lit(0)))
    by = ["row", "line_no", "line_start", "place", "so_far"]
    tokens = located(hit, by, found, F.split("line", TOKEN, -1))
    name = F.when(F.col("kind") == "email", F.lower("value")).when(F.col("kind") == "ip", F.col("value"))
    entity = F.concat_ws(":", "kind", name.otherwise(digits(F.col("value"))))
    null = F.lit(None)
    events = tokens.select(
        *by, "start", "end", "i", F.lower("value").alias("term"),
        null.cast("string").alias("entity"), null.cast("int").alias("own"),
    )
    placed = spans.join(hit.select("row", "line_no", "place", "so_far"), ["row", "line_no"])
    events = events.unionByName(
        placed.select(
            *by, "start", "end", null.cast("int").alias("i"), null.cast("string").alias("term"), entity.alias("entity"),
            F.size(F.regexp_extract_all("value", F.lit(TOKEN), 0)).alias("own"),
        )
    )
    # spans come before the tokens that start where they do
    order = Window.partitionBy("row", "line_no").orderBy("start", F.col("i").isNotNull(), "i", "entity")
    past, ahead = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(0, Window.unboundedFollowing)
    is_span = F.col("entity").isNotNull()
    events = events.select(
        "*",
        F.max(F.when(is_span, F.col("end"))).over(past).alias("reach"),
        F.min(F.when(is_span, F.col("start"))).over(ahead).alias("next"),
        F.max("i").over(past).alias("last"),
    )
    index = F.coalesce("i", F.col("last") + 1, F.lit(0))
    events = stored(events.withColumn("at", F.col("so_far") + index), "pii_tokens")
    free = (F.coalesce("reach", F.lit(0)) <= F.col("start")) & (F.coalesce("next", F.col("end")) >= F.col("end"))
    terms = events.where(F.col("entity").isNull() & free & (F.length("term") >= LEAST_LETTERS))
    terms = terms.select("row", "line_no", "line_start", "term", "start", "end", "at", "place")
    last = F.col("at") + F.greatest("own", F.lit(1)) - 1
    entities = events.where("entity is not null")
    return terms, entities.select("row", "entity", F.col("at").alias("first"), last.alias("last"), "place").distinct()


def meetings(terms: DataFrame, entities: DataFrame) -> DataFrame:
    """(row, term, entity, place, e_place) of terms at most ``NEAR`` tokens from an entity."""
    cells = F.sequence(F.floor((F.col("first") - NEAR) / NEAR), F.floor((F.col("last") + NEAR) / NEAR))
    around = entities.select("row", "entity", "first", "last", F.col("place").alias("e_place"), F.explode(cells).alias("cell"))
    both = terms.withColumn("cell", F.floor(F.col("at") / NEAR)).join(around, ["row", "cell"])
    both = both.where(F.col("at").between(F.col("first") - NEAR, F.col("last") + NEAR))
    return both.select("row", "term", "entity", "place", "e_place")


def disclosing(terms: DataFrame, entities: DataFrame, texts: DataFrame) -> DataFrame:
    """(term, entity, removed): terms that disclose more than the thresholds allow."""
    pair = ["term", "entity"]
    # two different places are there just when the least and the greatest differ
    ends = [f(c).alias(f"{f.__name__}_{c}") for c in ("place", "e_place") for f in (F.min, F.max)]
    by_row = meetings(terms, entities).groupBy("row", *pair).agg(*ends)
    apart = [F.min(f"min_{c}") < F.max(f"max_{c}") for c in ("place", "e_place")]
    pairs = by_row.groupBy(*pair).agg(F.count(F.lit(1)).alias("n_te"), (apart[0] & apart[1]).alias("apart"))
    pairs = stored(pairs.where("apart").drop("apart"), "pii_pairs")
    wanted = pairs.select("term").unionByName(texts.sparkSession.range(1).select(F.lit("").alias("term"))).distinct()
    # an inner join: a semi join would be moved below the counting and move every word
    counts = stored(corpus_counts(texts).join(wanted, "term"), "pii_counts")
    documents = F.lit((counts.where("term = ''").agg(F.max("n")).first() or [None])[0]).cast("double")
    of_entity = entities.select("row", "entity").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"))
    known = pairs.join(counts.withColumnRenamed("n", "n_t"), "term").join(of_entity, "entity")
    share = 1 - F.log(F.col("n_t") / F.col("n_te")) / F.log(documents / F.col("n_e"))
    known = known.withColumn("share", F.when(documents > F.col("n_e"), share))
    return known.where(F.col("share") >= GENERALISE).select("term", "entity", (F.col("share") >= REMOVE).alias("removed"))


def all_spans(suspects: DataFrame, texts: DataFrame) -> DataFrame:
    """Stored (row, line_no, line_start, kind, start, end, removed) of base spans and terms."""
    lines = lines_of(suspects)
    base = stored(base_spans(lines), "pii_base")
    terms, entities = marked_tokens(lines, base)
    found = disclosing(terms, entities, texts)
    told = entities.select("row", "entity").distinct().join(found, "entity")
    told = told.groupBy("row", "term").agg(F.max("removed").alias("removed"))
    shown = terms.join(told, ["row", "term"]).select("row", "line_no", "line_start", "start", "end", "removed")
    columns = ["row", "line_no", "line_start", "kind", "start", "end", "removed"]
    both = base.withColumn("removed", F.lit(False)).select(*columns).unionByName(
        shown.withColumn("kind", F.lit(TERM)).select(*columns)
    )
    return stored(both, "pii_spans")


def suspects_of(rows: DataFrame) -> DataFrame:
    """(row, doc_id, text) with the text only where a base span is possible."""
    return rows.withColumn("text", F.when(F.col("text").rlike(SUSPECT), F.col("text")))


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, the counts of the four kinds, base_sha256 and spans of every row."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    rows = stored(suspects_of(texts.withColumn("row", F.monotonically_increasing_id())), "pii_rows")
    spans = all_spans(rows, texts)
    number = F.element_at(F.create_map(*[F.lit(x) for k, v in enumerate(KINDS) for x in (v, k)]), F.col("kind"))
    start, end = F.col("line_start") + F.col("start"), F.col("line_start") + F.col("end")
    entry = F.struct(number.alias("k"), start.alias("s"), end.alias("e"), "kind")

    def joined(entries: Column) -> Column:
        return F.concat_ws(",", F.transform(F.array_sort(entries), lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])))

    is_base = F.col("kind") != TERM
    per_row = spans.groupBy("row").agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in PATTERNS],
        joined(F.collect_list(F.when(is_base, entry))).alias("base"),
        joined(F.collect_list(entry)).alias("spans"),
    )
    full = rows.select("row", "doc_id").join(per_row, "row", "left")
    empty = F.lit("")
    return full.select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in PATTERNS],
        F.sha2(F.coalesce("base", empty), 256).alias("base_sha256"),
        F.coalesce("spans", empty).alias("spans"),
    )


def redacted_lines(lines: DataFrame, spans: DataFrame) -> DataFrame:
    """(row, line_no, line) with the spans replaced; of overlapping spans the
    first one names the mark and the others' remains go with it."""
    order = Window.partitionBy("row", "line_no").orderBy("start", F.desc("end"), "kind")
    reach = F.coalesce(F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    mark = F.when(F.col("kind") != TERM, F.concat(F.lit("["), F.upper("kind"), F.lit("]")))
    mark = mark.otherwise(F.when(F.col("removed"), F.lit("[REMOVED]")).otherwise(F.lit("[TERM]")))
    cut = spans.select("*", reach.alias("reach"), mark.alias("mark")).where(F.col("end") > F.col("reach"))
    # what an earlier span overlaps gets no mark of its own
    cut = cut.withColumn("mark", F.when(F.col("start") >= F.col("reach"), F.col("mark")).otherwise(F.lit("")))
    piece = F.struct(F.greatest("start", "reach").alias("start"), "end", "reach", "mark")
    per_line = cut.groupBy("row", "line_no").agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
    joined = lines.join(per_line, ["row", "line_no"], "left")

    def rendered(p: Column) -> Column:
        return F.concat(F.substring("line", p["reach"] + 1, p["start"] - p["reach"]), p["mark"])

    last = F.element_at("pieces", -1)["end"]
    tail = F.substring("line", last + 1, F.length("line"))
    line = F.when(F.col("pieces").isNull(), F.col("line")).otherwise(
        F.concat(F.array_join(F.transform("pieces", rendered), ""), tail)
    )
    return joined.select("row", "line_no", line.alias("line"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with all spans replaced in ``text`` and, where there is such a
    column, ``n_chars`` counted anew for the texts that changed."""
    row, new = free_name(docs, "_row"), free_name(docs, "_text")
    marked = stored(docs.withColumn(row, F.monotonically_increasing_id()), "pii_docs")
    texts = marked.select(F.col(row).alias("row"), text_or_empty().alias("text"))
    suspects = suspects_of(texts)
    spans = all_spans(suspects, texts)
    hit = suspects.join(spans.select("row").distinct(), "row", "left_semi")
    lines = redacted_lines(lines_of(hit), spans)
    entry = F.struct("line_no", "line")
    whole = lines.groupBy("row").agg(F.array_sort(F.collect_list(entry)).alias("l"))
    whole = whole.select(F.col("row").alias(row), F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias(new))
    full = marked.join(whole, row, "left")
    out = []
    for name, kind in docs.dtypes:
        if name == "text":
            out.append(F.coalesce(new, "text").alias(name))
        elif name == "n_chars":
            out.append(F.when(F.col(new).isNotNull(), F.length(new)).otherwise(F.col(name)).cast(kind).alias(name))
        else:
            out.append(F.col(name))
    return full.select(*out)
