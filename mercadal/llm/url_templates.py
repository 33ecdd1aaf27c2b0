"""URL verdicts by rules and by a tree of path templates.

Rules decide the addresses they fit (the longest fitting rule wins) and label
them for the tree. Per host, and once over all hosts, paths are laid out as a
tree of segments. Segments that vary by form (numbers, hexadecimal or very long
names) become wildcards at once. Level by level, sibling branches whose labelled
block rate does not differ from that of the other siblings (two-proportion z
test) are merged into the wildcard; a branch that stands out keeps its name. A
template's purity, its block rate smoothed by the template of the same address
over all hosts and that one by the overall rate, rejects it above one half.

Only DataFrame functions are used. Null addresses and addresses without ``://``
have an empty host and path. The tree is as deep as its labelled paths differ:
levels follow while some template still holds both verdicts, and below that
every segment is a wildcard. Repeated rows are judged alike, extra columns are
not read, an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercadal.llm.tables import stored

# Fixed values: (verdict, host, path) of the given rules
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
Z_APART = 1.96
PRIOR_WEIGHT = 4.0
REJECT_ABOVE = 0.5
EVERY_HOST = "*"
ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, ADDRESS, 1), UPPER, LOWER), F.regexp_extract(url, ADDRESS, 2)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for said, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule = F.when(fits, F.lit(name + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def form_segments(path: Column) -> Column:
    """The path's segments with varying forms as wildcards."""
    parts = F.filter(F.split(path, "/", -1), lambda s: s != "")
    varies = r"^[0-9][0-9._-]*(\.[A-Za-z]+)?$|^(?=.*[0-9])[0-9a-fA-F-]{8,}$|^.{41,}$"
    return F.transform(parts, lambda s: F.when(s.rlike(varies), F.lit("*")).otherwise(s))


def any_mixed(rows: DataFrame) -> bool:
    """Whether a template with a further segment holds both verdicts. If none
    does, no branch at this level or below it can stand out."""
    sums = rows.where("labelled > 0").groupBy("tree", "template").agg(F.sum("labelled").alias("n"), F.sum("blocked").alias("b"))
    return not sums.where("b > 0 and b < n").isEmpty()


def branch_names(rows: DataFrame) -> DataFrame:
    """(tree, template, seg) of the branches that stand out from their siblings."""
    node = ["tree", "template"]
    branches = rows.groupBy(*node, "seg").agg(F.sum("labelled").alias("n"), F.sum("blocked").alias("b"))
    whole = rows.groupBy(*node).agg(F.sum("labelled").alias("all_n"), F.sum("blocked").alias("all_b"))
    both = branches.where("n > 0").join(whole, node)
    rest_n, rest_b = F.col("all_n") - F.col("n"), F.col("all_b") - F.col("b")
    rate = F.col("all_b") / F.col("all_n")
    spread = F.sqrt(rate * (1 - rate) * (1 / F.col("n") + 1 / rest_n))
    gap = F.abs(F.col("b") / F.col("n") - rest_b / rest_n)
    apart = F.when((rest_n > 0) & (rate > 0) & (rate < 1), gap > Z_APART * spread)
    return both.where(apart & (F.col("seg") != "*")).select(*node, "seg", F.lit(True).alias("named"))


def template_tree(paths: DataFrame) -> DataFrame:
    """Stored (tree, host, segs, labelled, blocked, template) for the host's own
    tree and the tree of all hosts, from distinct (host, segs) with counts."""
    trees = F.explode(F.array("host", F.lit(EVERY_HOST))).alias("tree")
    rows = paths.select(trees, "host", "segs", "labelled", "blocked", F.lit("").alias("template"))
    level = 0
    while any_mixed(rows.where(F.size("segs") > level)):
        rows = rows.withColumn("seg", F.get("segs", F.lit(level)))
        named = branch_names(rows.where("seg is not null"))
        rows = rows.join(named, ["tree", "template", "seg"], "left")
        step = F.when(F.col("named"), F.col("seg")).otherwise(F.lit("*"))
        longer = F.concat_ws("/", "template", step)
        rows = rows.withColumn("template", F.when(F.col("seg").isNull(), F.col("template")).otherwise(longer))
        rows = stored(rows.drop("seg", "named"), "url_level")
        level += 1
    below = F.repeat(F.lit("/*"), F.greatest(F.size("segs") - level, F.lit(0)))
    return rows.withColumn("template", F.concat("template", below))


def path_purity(paths: DataFrame) -> DataFrame:
    """(host, segs, template, purity): smoothed block rate for each path form."""
    rows = template_tree(paths)
    total = paths.agg(F.sum("labelled").alias("n"), F.sum("blocked").alias("b")).first()
    prior = (total["b"] or 0) / total["n"] if total["n"] else 0.0
    sums = rows.groupBy("tree", "template").agg(F.sum("labelled").alias("n"), F.sum("blocked").alias("b"))
    placed = rows.select("tree", "host", "segs", "template").join(sums, ["tree", "template"])
    own, every = F.col("tree") != EVERY_HOST, F.col("tree") == EVERY_HOST

    def of(which: Column, name: str) -> Column:
        return F.coalesce(F.max(F.when(which, F.col(name))), F.lit(0))

    both = placed.groupBy("host", "segs").agg(
        F.max(F.when(own, F.col("template"))).alias("template"),
        of(own, "n").alias("n"), of(own, "b").alias("b"), of(every, "n").alias("gn"), of(every, "b").alias("gb"),
    )
    general = (F.col("gb") + PRIOR_WEIGHT * prior) / (F.col("gn") + PRIOR_WEIGHT)
    purity = (F.col("b") + PRIOR_WEIGHT * general) / (F.col("n") + PRIOR_WEIGHT)
    return both.select("host", "segs", F.coalesce("template", F.lit("")).alias("template"), purity.alias("purity"))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, template and purity of every page."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule.alias("rule"), said.alias("said"), form_segments(F.col("path")).alias("segs"))
    paths = rows.groupBy("host", "segs").agg(
        F.count("said").alias("labelled"), F.count_if(F.col("said") == "block").alias("blocked")
    )
    purity = path_purity(stored(paths, "url_paths"))
    learned = F.when(F.col("purity") > REJECT_ABOVE, F.lit("block")).otherwise(F.lit("allow"))
    return rows.join(purity, ["host", "segs"]).select(
        "page_id", "host", "path", "rule", F.coalesce("said", learned).alias("verdict"), "template", "purity"
    )
