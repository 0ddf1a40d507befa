"""Numbered lists of laws in two editions, entries read twice, and what is left for the eye.

Lines of a text are rows (doc, place, text): ``place`` is their order. Where a pattern is a parameter, its groups are named in
the docstring; the defaults are how the two editions print.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.functions.text import article_key, squeezed
from cadastra.operators.sequence import continued, rising
from cadastra.operators.transcribe import numbered_items


@dataclass(frozen=True)
class Printed:
    """How an edition prints: ``header`` (1: article, 2: number of members), ``amending`` (1: the article of the text itself that writes
    others), ``item`` (1: number, 2: name), ``article``: a line that begins one."""

    header: str
    amending: str = "$^"
    item: str = "$^"
    article: str = "$^"


LATIN = Printed(
    header=r"Art\.? ?([0-9]+(?:\.? ?[Bb]is ?[0-9]*)?)\.? ?[—–-]+ ?[^:;.(]{1,120}\(([0-9]+) ?\) communes suivantes[^:;.]{0,40}:",
    amending=r"(?<![«\p{L}])Art\.? ?([0-9]+) ?\.? ?[—–-]+ ?L(?:es dispositions|['’]intitulé)",
)
ARABIC = Printed(
    header=r"الماد[ّ]?ة ([0-9]+(?: مكرر ?[0-9]*)?) ?: ?تتشكل ولاية .{1,80}?[!(,] ?([0-9]+) ?\)",
    item=r"^([0-9]{1,2}) ?[.–-] ?([^0-9 ،.].*?)[ ،,.:”“\"»«!]*$",
    article=r"^[\"”“«]? ?الماد[ّ]?ة ",
)


def latin_lists(lines: DataFrame, by: list[str], *, printed: Printed = LATIN, noise: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(lists, items) of a Latin edition: (by, list, article, via, announced) and (by, list, number, name).

    Two streams of markers cut a text: headers, each of which begins a list, and amending articles, which end one and name
    the article (``via``) that writes the lists behind them. A text is put together from its lines, without those like ``noise``,
    as a header may run over several; it is cut at its headers, and each piece at its first amending article. The last
    amending article ahead of a header is carried forward over the pieces. Lists count from 0 in a text; nulls are no
    lines; texts without headers have no lists.
    """
    shown = lines.where(F.col("text").isNotNull() & (F.trim("text") != ""))
    if noise:
        shown = shown.where(~F.trim("text").rlike(noise))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "text"))), lambda r: F.trim(r["text"])), " ")
    texts = shown.groupBy(*by).agg(F.regexp_replace(joined, r"\s+", " ").alias("whole"))
    heads = F.regexp_extract_all("whole", F.lit(printed.header), F.lit(0))
    # piece k lies ahead of header k, piece 0 ahead of all; each has the header before it alone, as a text has as many of both
    cut = lambda found: F.transform(F.split("whole", printed.header), lambda piece, k: F.struct(F.get(found, k - 1).alias("head"), piece.alias("piece")))
    pieces = texts.withColumn("heads", heads).where(F.size("heads") > 0).select(*by, F.posexplode(F.transform(F.array("heads"), cut)[0]).alias("list", "cut")).select(*by, "list", "cut.head", "cut.piece")
    named = F.regexp_extract_all("piece", F.lit(printed.amending), F.lit(1))
    pieces = pieces.withColumn("wrote", F.when(F.size(named) > 0, F.element_at(named, -1)))
    order = Window.partitionBy(*by).orderBy("list")
    pieces = pieces.withColumn("via", F.last("wrote", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))).where("list > 0")
    head = F.col("head")
    body = F.get(F.split("piece", printed.amending), F.lit(0))
    rows = pieces.select(
        *by, (F.col("list") - 1).alias("list"), article_key(F.replace(F.regexp_extract(head, printed.header, 1), F.lit("."), F.lit(" "))).alias("article"),
        F.coalesce("via", F.lit("")).alias("via"), F.regexp_extract(head, printed.header, 2).cast("int").alias("announced"), body.alias("body"),
    )
    return rows.drop("body"), numbered_items(rows, F.col("body")).select(*by, "list", "number", "name")


def arabic_lists(lines: DataFrame, by: list[str], *, printed: Printed = ARABIC) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lists, items, dropped) of a read Arabic edition, from lines (by, place, text): (by, list, article, announced), (by, list,
    number, name, place) and the item lines that were left out.

    A line that begins an article opens a section; it and the lines behind it, up to the first item, are its head, which may
    be wrapped. A section whose head is that of a list has its items, the others' items are nobody's. Of a list's items
    those count whose number rises and is not above the announced one. ``list`` is the number of the section in its text.
    """
    text = F.trim("text")
    rows = lines.where(F.col("text").isNotNull()).withColumn("text", text)
    along = Window.partitionBy(*by).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    opens = F.col("text").rlike(printed.article)
    rows = rows.withColumn("list", F.sum(opens.cast("int")).over(along)).where("list > 0").withColumn("is_item", F.col("text").rlike(printed.item))
    inside = Window.partitionBy(*by, "list").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("items_so_far", F.sum(F.col("is_item").cast("int")).over(inside))
    head = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "text"))), lambda r: r["text"]), " ")
    heads = rows.where("items_so_far = 0").groupBy(*by, "list").agg(F.regexp_replace(head, r"\s+", " ").alias("head")).where(F.col("head").rlike(printed.header))
    article = F.regexp_replace(F.regexp_extract("head", printed.header, 1), "مكرر", "bis")
    found = heads.select(*by, "list", article_key(article).alias("article"), F.regexp_extract("head", printed.header, 2).cast("int").alias("announced"))
    items = rows.where("is_item").join(found.select(*by, "list", "announced"), [*by, "list"])
    items = items.select(*by, "list", "place", "announced", F.regexp_extract("text", printed.item, 1).cast("int").alias("number"), F.trim(F.regexp_extract("text", printed.item, 2)).alias("name"))
    kept = rising(items, [*by, "list"], "place", "number", F.col("announced")).drop("announced")
    dropped = items.join(kept.select(*by, "place"), [*by, "place"], "left_anti").drop("announced")
    return found, kept.select(*by, "list", "number", "name", "place"), dropped.select(*by, "list", "number", "name", "place")


def read_entries(lines: DataFrame, by: list[str], *, starts: str, entry: str) -> DataFrame:
    """(by, entry, name, seat, text) of one reading of a list: lines (by, place, text) that don't start one go on with the entry
    above; ``entry`` (1: name, 2: seat) takes it apart, what it doesn't fit is a name as a whole. Entries count from 1 in
    each group, so that a list whose numbers restart has an entry for each place. Lines ahead of the first start are one."""
    shown = lines.where(F.col("text").isNotNull()).withColumn("text", F.trim(F.regexp_replace("text", r"\s+", " ")))
    first = F.row_number().over(Window.partitionBy(*by).orderBy("place")) == 1
    rows = shown.withColumn("begins", F.col("text").rlike(starts) | first)
    whole = continued(rows, by, "place", "text", F.col("begins"))
    fits = F.col("text").rlike(entry)
    tail = lambda c: F.regexp_replace(c, r"[\s»«*؛؟()]+$", "")
    return whole.select(*by, "entry", tail(F.when(fits, F.regexp_extract("text", entry, 1)).otherwise(F.col("text"))).alias("name"), F.when(fits, tail(F.regexp_extract("text", entry, 2))).otherwise("").alias("seat"), "text")


def merged_readings(one: DataFrame, two: DataFrame, by: list[str]) -> DataFrame:
    """(by, entry, name, seat, source, check) of two readings (by, entry, name, seat) of a list, entry by entry.

    Equal readings are ``both`` with no check; if they differ in blanks alone, the first holds with check ``spaces``; else the
    first holds with ``differs``, or the one with a seat if the other has none. An entry that one reading alone has
    is ``single``. ``source`` says whose it is: 1, 2 or both.
    """
    side = lambda f, k: f.select(*by, "entry", F.struct("name", "seat").alias(f"r{k}"))
    rows = side(one, 1).join(side(two, 2), [*by, "entry"], "full_outer")
    a, b = F.col("r1"), F.col("r2")
    bare = lambda r: squeezed(F.concat_ws("|", r["name"], r["seat"]))
    alike = (a["name"] == b["name"]) & (a["seat"] == b["seat"])
    second = a.isNull() | (b.isNotNull() & (a["seat"] == "") & (b["seat"] != ""))
    source = F.when(alike, "both").when(second, "2").otherwise("1")
    check = F.when(a.isNull() | b.isNull(), "single").when(alike, "").when(bare(a) == bare(b), "spaces").otherwise("differs")
    chosen = F.when(second, b).otherwise(a)
    return rows.select(*by, "entry", chosen["name"].alias("name"), chosen["seat"].alias("seat"), source.alias("source"), check.alias("check"))


#: Doubts from the gravest: what no reading has, what one has, what two have differently.
TIERS = ("missing", "single", "ocr", "pdf", "differs", "order", "gap", "spaces")


def worklist(rows: DataFrame, by: list[str], order: str, *, tiers: tuple[str, ...] = TIERS, line: float = 0.012, margin: float = 0.01) -> DataFrame:
    """``rows`` with a doubt (``check``, not empty), and tier, rank, top and bottom: what to look at first, and where.

    Rows are placed by ``y`` and ``h``, null where nothing was found; ``by`` names a column of a page. A row's stretch reaches over
    the rows next to it that lie within three lines; one without a place is looked for between its neighbours, or two lines
    behind or ahead of the only one, and has no stretch without any. Ranks count from 1 within each document's tier
    order, over all pages; unknown doubts come last. Each row is ranked; none is left out.
    """
    w = Window.partitionBy(*by).orderBy(order)
    box = F.when(F.col("y").isNotNull(), F.struct(F.col("y").alias("a"), (F.col("y") + F.col("h")).alias("b")))
    placed = rows.withColumn("_box", box).withColumn("_before", F.lag("_box").over(w)).withColumn("_after", F.lead("_box").over(w))
    own, before, after = F.col("_box"), F.col("_before"), F.col("_after")
    near = lambda other: F.when(F.abs(other["a"] - own["a"]) < 3 * line, other)
    top = F.when(own.isNotNull(), F.least(own["a"], near(before)["a"], near(after)["a"])).when(before.isNotNull(), before["a"]).otherwise(after["a"] - 2 * line)
    between = before.isNotNull() & after.isNotNull() & (after["a"] > before["a"])
    bottom = F.when(own.isNotNull(), F.greatest(own["b"], near(before)["b"], near(after)["b"])).when(between, after["b"]).when(before.isNotNull(), before["b"] + 2 * line).otherwise(after["b"])
    bottom = bottom + F.when(after.isNull(), F.lit(line)).otherwise(F.lit(0.0))
    tier = F.coalesce(*(F.when(F.col("check") == t, F.lit(k)) for k, t in enumerate(tiers)), F.lit(len(tiers)))
    found = placed.withColumn("tier", tier).withColumn("top", F.greatest(F.lit(0.0), top - margin)).withColumn("bottom", F.least(F.lit(1.0), bottom + margin))
    found = found.where(F.coalesce("check", F.lit("")) != "").drop("_box", "_before", "_after")
    return found.withColumn("rank", F.row_number().over(Window.partitionBy(by[0]).orderBy("tier", *by[1:], order)))


def row_readings(rows: DataFrame, lines: DataFrame, by: list[str], reach: float) -> DataFrame:
    """(by, id, reading): for each row (id, at) the texts of the lines (id, at, x, text) whose place is within ``reach`` of
    the row's, joined from right to left; rows without one have none. A line near two rows is read for both."""
    from cadastra.operators.joins import nearest_within

    text = lines.where(F.coalesce(F.trim("text"), F.lit("")) != "")
    pairs = nearest_within(rows.select(*by, "id", "at"), text.select(*by, "id", "at"), by, "at", reach)
    parts = pairs.join(text.select(F.col("id").alias("r_id"), "x", "text"), "r_id")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("x")).alias("x"), "r_id", "text"))), lambda p: p["text"]), " ")
    return parts.groupBy(*by, F.col("l_id").alias("id")).agg(joined.alias("reading"))
