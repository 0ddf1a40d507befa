"""URL filter: explicit rules first, then a tree of path templates for each host.

Level by level, a path segment with little support is variable and becomes a wildcard; the others stay and are
branches. The support asked for is a share of the node's visits, but never more than ``ENOUGH_VISITS``, so that the
sections of a very large host stay apart. Branches of a node with alike labelled shares are merged: those of one band of shares,
if a test of homogeneity finds that none differs from the pooled share by more than chance. Levels go on until all
paths end: one segment each at first, then two, four ..., so that a path of a thousand segments takes a few levels
more. The leaves are templates. A template is rejected if its labelled purity, smoothed towards that of all labelled
pages, is low beyond chance; one without labels has none to be rejected by. All levels are joins and aggregations
over (host, path) with counts, never single visits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.llm.common import checkpoint

#: Levels of one segment; the levels after them take twice as many segments each.
SINGLE_LEVELS = 8
#: A segment stays literal with this share of its node's visits, and at least so many, or with enough visits of its own.
LITERAL_SHARE, LITERAL_VISITS, ENOUGH_VISITS = 0.05, 3, 16
#: Branches with so many labels are merged within bands of shares. On the scale of arcsines, where a share of n labels has
#: the variance 1 / n everywhere, a band is half a unit wide, about a sixth of all shares.
MERGE_LABELS, BAND = 3, 0.5
#: How far the spread of a group's shares may exceed its expectation, in standard deviations.
MERGE_Z = 1.645
#: Labels that the share of all labelled pages counts as, the purity to reach, and the standard errors of doubt in a template's favour.
SMOOTHING, LEAST_PURITY, REJECT_Z = 4.0, 0.5, 1.96
#: Arcsines are whole numbers of this size, so that sums of them don't depend on their order.
_UNIT = 1000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """(rule, verdict) of the longest (verdict, host, path) that fits host and path, or null."""
    out = None
    for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        value = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def _level(rows: DataFrame, at: int, width: int) -> DataFrame:
    """``rows`` with ``template`` ``width`` segments longer, from segment ``at`` on, where paths go so far."""
    ended = rows.where(F.size("segments") <= at)
    rows = rows.where(F.size("segments") > at).withColumn("segment", F.array_join(F.slice("segments", at + 1, width), "/"))
    node = ["host", "template"]
    children = rows.groupBy(*node, "segment").agg(*(F.sum(c).alias(c) for c in ("visits", "good", "bad")))
    nodes = children.groupBy(*node).agg(F.sum("visits").alias("all_visits"))
    support = F.least(F.lit(float(ENOUGH_VISITS)), F.greatest(F.lit(float(LITERAL_VISITS)), LITERAL_SHARE * F.col("all_visits")))
    literal = children.join(nodes, node).where(F.col("visits") >= support)
    labelled = F.col("good") + F.col("bad")
    angle = F.round(2 * _UNIT * F.asin(F.sqrt(F.col("good") / F.greatest(labelled, F.lit(1))))).cast("long")
    literal = literal.withColumn("n", labelled).withColumn("angle", angle)
    literal = literal.withColumn("band", F.when(labelled >= MERGE_LABELS, F.floor(F.col("angle") / (BAND * _UNIT))))
    sums = [F.count(F.lit(1)).alias("k"), F.sum("n").alias("s0"), F.sum(F.col("n") * F.col("angle")).alias("s1"), F.sum(F.col("n") * F.col("angle") * F.col("angle")).alias("s2"), F.min("segment").alias("least")]
    bands = literal.where("band IS NOT NULL").groupBy(*node, "band").agg(*sums)
    spread = (F.col("s2") - F.col("s1") / F.col("s0") * F.col("s1")) / (_UNIT * _UNIT)
    alike = (F.col("k") > 1) & (spread <= F.col("k") - 1 + MERGE_Z * F.sqrt(2 * (F.col("k") - 1)))
    # a merged branch is named after its first segment: names of all would grow with the host
    merged = bands.where(alike).select(*node, "band", F.concat("least", F.lit("|+"), (F.col("k") - 1).cast("string")).alias("label"))
    names = literal.join(merged, [*node, "band"], "left").withColumn("label", F.coalesce("label", "segment"))
    found = rows.join(names.select(*node, "segment", "label"), [*node, "segment"], "left")
    label = F.concat(F.lit("/"), F.coalesce("label", F.lit("*" if width == 1 else "**")))
    longer = found.select("host", "path", "segments", "visits", "good", "bad", F.concat("template", label).alias("template"))
    return longer.unionByName(ended.select(longer.columns))


def templates(visits: DataFrame) -> DataFrame:
    """(host, path, template, purity, labels) for each host and path of ``visits`` (host, path, good: 1, 0 or null).

    ``purity`` is the share of good ones among a template's ``labels`` labelled visits, smoothed.
    """
    good = F.coalesce(F.sum("good"), F.lit(0)).alias("good")
    rows = visits.groupBy("host", "path").agg(F.count(F.lit(1)).alias("visits"), good, (F.count("good") - F.coalesce(F.sum("good"), F.lit(0))).alias("bad"))
    rows = rows.withColumn("segments", F.filter(F.split("path", "/"), lambda s: s != "")).withColumn("template", F.lit(""))
    rows = checkpoint(rows)
    longest, at, depth = rows.agg(F.max(F.size("segments"))).first()[0] or 0, 0, 0
    while at < longest:
        width = 1 << max(0, depth - SINGLE_LEVELS + 1)
        rows = checkpoint(_level(rows, at, width))
        at, depth = at + width, depth + 1
    base = rows.agg(((F.coalesce(F.sum("good"), F.lit(0)) + 1) / (F.coalesce(F.sum(F.col("good") + F.col("bad")), F.lit(0)) + 1)).alias("p")).first()["p"]
    leaves = rows.groupBy("host", "template").agg(F.sum("good").alias("g"), F.sum("bad").alias("b"))
    labels = F.col("g") + F.col("b")
    leaves = leaves.select("host", "template", ((F.col("g") + SMOOTHING * base) / (labels + SMOOTHING)).alias("purity"), labels.alias("labels"))
    return rows.select("host", "path", "template").join(leaves, ["host", "template"]).select("host", "path", "template", "purity", "labels")


def rejected(purity: Column, labels: Column) -> Column:
    """Whether a template's purity is so low that chance doesn't explain it: below ``LEAST_PURITY`` by ``REJECT_Z`` standard errors.
    Never without labels, whatever the share of all labelled pages is."""
    error = F.sqrt(purity * (1 - purity) / (labels + SMOOTHING))
    return (labels > 0) & (purity + REJECT_Z * error < LEAST_PURITY)


def filtered(pages: DataFrame, rules: list[tuple[str, str, str]], *, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity, labels), a row for each row of ``pages``.

    A rule's verdict holds where one fits. The pages that rules judge are the labelled ones, allowed pages good
    and blocked ones bad; templates learn from them and judge the others. A template without labels is
    allowed. A null URL or one without ``://`` has an empty host and path, which is a template as well.
    Repeated and null ids are rows like others. An empty table gives no rows.
    """
    url = F.col(url_col).cast("string")
    parsed = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    judged = parsed.withColumn("by_rule", rule_of(F.col("host"), F.col("path"), rules))
    label = F.when(F.col("by_rule.verdict") == "allow", 1).when(F.col("by_rule.verdict") == "block", 0)
    learned = templates(judged.select("host", "path", label.alias("good")))
    own = F.when(rejected(F.col("purity"), F.col("labels")), "block").otherwise("allow")
    return judged.join(learned, ["host", "path"]).select(
        "page_id", "host", "path", F.col("by_rule.rule").alias("rule"), F.coalesce(F.col("by_rule.verdict"), own).alias("verdict"), "template", "purity", "labels"
    )
