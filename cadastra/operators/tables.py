"""Printed tables read back from placed parts: bands between rules, seats and members, several readings of one name.

A part is a run of text or a reader's line: ``ord`` (its place in the input), ``src`` (who read it), a box x, y, w, h, and
``text``. Its page, side and whatever else tells documents apart are columns that the caller names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.operators.checks import require_none
from cadastra.operators.joins import bands, into_bands
from cadastra.operators.sequence import clustered


@dataclass(frozen=True)
class Layout:
    """How a table is printed. Lengths are parts of a page."""

    heading: str  # a part that announces a table: a pattern whose first group is its number
    end: str  # the text behind the last table
    unchanged: str  # a mark in place of the members of a row that stays
    furniture: str  # bands that are no rows, where names have no dashes
    dash: str = r"^\s*[-–—]"
    dashed: bool = True  # members have dashes; else they stand right of the seats
    right_to_left: bool = False
    best: str = "pdf"  # the source whose boxes place columns best
    line: float = 0.006  # parts whose middles lie closer to the mean of a line are on it
    slack: float = 0.004
    seat_gap: float = 0.05
    head: float = 0.0  # parts above are a page's head
    least_band: float = 0.0
    words: str = r"[\p{L}\p{N}_]"


def _middle() -> Column:
    return F.col("y") + F.col("h") / 2


def _banded(parts: DataFrame, rules: DataFrame, by: list[str], layout: Layout) -> DataFrame:
    """``parts`` with ``middle``, ``band``, ``top`` and ``bottom``. A page without rules is one band, narrow bands have no parts."""
    pages = parts.select(*by).distinct()
    cut = bands(rules.select(*by, "y").join(pages, by, "left_semi"), by, "y", low=0.0, high=1.0, least=layout.least_band)
    whole = pages.join(rules.select(*by).distinct(), by, "left_anti").select(*by, F.lit(0).alias("band"), F.lit(0.0).alias("top"), F.lit(1.0).alias("bottom"))
    placed = parts.where((F.col("y") >= layout.head) & F.col("text").isNotNull()).withColumn("middle", _middle())
    return into_bands(placed, cut.unionByName(whole), by, "middle").where(F.col("band").isNotNull())


def _band_kinds(parts: DataFrame, layout: Layout, by: list[str]) -> DataFrame:
    """Of each band its number, if it announces a table, whether the tables end in it, and what its columns are cut by."""
    text = F.col("text")
    number = F.regexp_extract(text, layout.heading, 1)
    dash = text.rlike(layout.dash)
    mark = text.rlike(layout.unchanged)
    right = F.col("x") + F.col("w")
    edge = F.max(F.when(dash, right)) if layout.right_to_left else F.min(F.when(dash, F.col("x")))
    best = F.when(dash & (F.col("src") == layout.best), right if layout.right_to_left else F.col("x"))
    best = F.max(best) if layout.right_to_left else F.min(best)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda p: p["text"]), " ")
    return parts.groupBy(*by, "band", "top", "bottom").agg(
        F.min_by(F.when(text.rlike(layout.heading), number), F.when(text.rlike(layout.heading), F.col("ord"))).alias("number"),
        F.max(text.rlike(layout.end)).alias("ends"),
        F.max(mark).alias("marked"),
        F.min(F.when(mark, F.col("x"))).alias("mark_left"),
        F.max(F.when(mark, right)).alias("mark_right"),
        F.coalesce(best, edge).alias("edge"),
        F.min("x").alias("left"),
        joined.rlike(layout.furniture).alias("furniture"),
    )


def _lines(parts: DataFrame, by: list[str], tolerance: float) -> DataFrame:
    """``parts`` with ``line``: within a group, those around the running mean of their middles."""
    return clustered(parts, by, "middle", tolerance, "mean").withColumnRenamed("cluster", "line")


def names(parts: DataFrame, by: list[str], layout: Layout) -> DataFrame:
    """by, ``texts`` (a map from source to text) and the box of each name that ``parts`` make up.

    A source's parts are put in lines, lines from the top, parts in reading order; the dash goes, blanks are single and
    letters are not stretched. A source without parts has no entry, and one whose text is empty has an empty one.
    """
    read = _lines(parts, [*by, "src"], layout.line)
    along = -F.col("x") if layout.right_to_left else F.col("x")
    piece = F.struct("line", along.alias("along"), "ord", F.regexp_replace("text", layout.dash, "").alias("text") if layout.dashed else F.col("text"))
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(piece)), lambda p: p["text"]), " ")
    clean = F.btrim(F.regexp_replace(F.regexp_replace(whole, "ـ", ""), r"\s+", " "))
    texts = read.groupBy(*by, "src").agg(clean.alias("text"), F.min("x").alias("x"), F.min("y").alias("y"), F.max(F.col("x") + F.col("w")).alias("r"), F.max(F.col("y") + F.col("h")).alias("b"))
    box = [F.min("x").alias("x"), F.min("y").alias("y"), (F.max("r") - F.min("x")).alias("w"), (F.max("b") - F.min("y")).alias("h")]
    return texts.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("src", "text")))).alias("texts"), *box)


def band_tables(parts: DataFrame, rules: DataFrame, document: list[str], page: list[str], order: list[Column | str], layout: Layout) -> DataFrame:
    """(document, number, row, item, page, band, unchanged, texts, x, y, w, h): the tables that ``parts`` print, between ``rules``.

    A document's bands follow each other in ``order`` (columns of ``page``) and from the top. A band with a heading begins the
    table of its number and is no row, one with the text behind the tables ends it; bands before the first table are
    nothing. A row is a band of a table: item 0 is its seat, 1 and on its members. Where members have dashes, the dashes
    part the columns and a line without one goes on with the name above; else every line right of the seats is a
    member. A band that says unchanged is a row with a seat alone, or nothing without a seat. ``row`` counts
    a number's rows from 1, over all bands that it heads. A seat that can't be read has no texts and the band's box.

    Parts without text, without a document or page, or in no band count nowhere. Without dashes, a band whose parts all stand at
    the seats is an IntegrityError. Work is shuffled by band, and by document only for the carried headings, with a
    row for each band.
    """
    by = [*document, *page]
    inside = _banded(parts, rules, by, layout)
    kinds = _band_kinds(inside, layout, by)
    place = Window.partitionBy(*document).orderBy(*order, "band").rowsBetween(Window.unboundedPreceding, 0)
    mark = F.when(F.col("number").isNotNull(), F.struct(F.col("number").alias("n"))).when(F.col("ends"), F.struct(F.lit(None).cast("string").alias("n")))
    heads = kinds.withColumn("current", F.last(mark, ignorenulls=True).over(place)["n"])
    rows = heads.where("number IS NULL AND current IS NOT NULL")  # a band that ends the tables has no current number
    plain = F.col("marked") | (F.col("edge").isNotNull() if layout.dashed else ~F.col("furniture"))
    rows = rows.where(plain).withColumnRenamed("current", "table").drop("number", "ends", "furniture")

    met = inside.join(rows, [*by, "band", "top", "bottom"])
    right = F.col("x") + F.col("w")
    aside = ~F.col("text").rlike(layout.unchanged) & F.col("text").rlike(layout.words) & ((right < F.col("mark_left") - layout.slack) | (F.col("x") > F.col("mark_right") + layout.slack))
    if not layout.dashed:
        cut = F.min(F.when(F.col("x") > F.col("left") + layout.seat_gap, F.col("x"))).over(Window.partitionBy(*by, "band"))
        met = met.withColumn("edge", cut)
        require_none(met.where("NOT marked AND edge IS NULL").select(*by, "band"), "no members beside a seat")
        seat, member = F.col("x") < F.col("edge"), F.col("x") >= F.col("edge")
    elif layout.right_to_left:
        seat, member = F.col("x") >= F.col("edge") - layout.slack, right <= F.col("edge") + layout.slack
    else:
        seat, member = right <= F.col("edge") + layout.slack, F.col("x") >= F.col("edge") - layout.slack
    marked = F.col("marked")
    seats = met.where(F.when(marked, aside).otherwise(seat)).withColumn("item", F.lit(0).cast("long"))
    lines = _lines(met.where(~marked & member), [*by, "band"], layout.line)
    if layout.dashed:
        begins = lines.groupBy(*by, "band", "line").agg(F.max(F.col("text").rlike(layout.dash)).alias("begins"))
        along = Window.partitionBy(*by, "band").orderBy("line")
        item = F.sum((F.col("begins") | (F.col("line") == 0)).cast("long")).over(along.rowsBetween(Window.unboundedPreceding, 0))
        members = lines.join(begins.select(*by, "band", "line", item.alias("item")), [*by, "band", "line"])
    else:
        members = lines.withColumn("item", F.col("line") + 1)
    key = [*by, "band", "item"]
    found = names(seats.select(*key, "ord", "src", "x", "y", "w", "h", "middle", "text").unionByName(members.select(*key, "ord", "src", "x", "y", "w", "h", "middle", "text")), key, layout)

    # an unchanged row without a seat is nothing, another row without one has an empty seat
    seated = found.where("item = 0").select(*by, "band", F.lit(True).alias("seated"))
    rows = rows.join(seated, [*by, "band"], "left").where(F.col("seated") | ~F.col("marked"))
    numbered = rows.withColumn("row", F.row_number().over(Window.partitionBy(*document, "table").orderBy(*order, "band")).cast("long"))
    numbered = numbered.select(*by, "band", "top", "bottom", F.col("table").alias("number"), "row", F.col("marked").alias("unchanged"), "seated")
    empty = numbered.where("seated IS NULL").select(
        *by, "band", F.lit(0).cast("long").alias("item"), F.create_map().cast("map<string,string>").alias("texts"),
        F.lit(0.0).alias("x"), F.col("top").alias("y"), F.lit(1.0).alias("w"), (F.col("bottom") - F.col("top")).alias("h"),
    )
    out = found.unionByName(empty.select(found.columns)).join(numbered, [*by, "band"])
    return out.select(*document, "number", "row", "item", *page, "band", "unchanged", "texts", "x", "y", "w", "h")


def uncovered(parts: DataFrame, rules: DataFrame, by: list[str], covered: DataFrame, *, least: float, gap: float, head: float = 0.0, high: float = 1.0, least_band: float = 0.0) -> DataFrame:
    """(by, band, y, h): the stretches of each band that no box of ``covered`` (by, y, h) reaches, to be read again.

    Stretches closer than ``gap`` are one, those lower than ``least`` are left out. Bands are those between ``rules`` of pages
    with parts, from the head to ``high``. The covered intervals of a band are swept in order with the furthest end so far; what
    lies between that end and the next interval is free. Null boxes cover nothing.
    """
    pages = parts.select(*by).distinct()
    cut = bands(rules.select(*by, "y").join(pages, by, "left_semi"), by, "y", low=0.0, high=high, least=least_band)
    whole = pages.join(rules.select(*by).distinct(), by, "left_anti").select(*by, F.lit(0).alias("band"), F.lit(0.0).alias("top"), F.lit(float(high)).alias("bottom"))
    cut = cut.unionByName(whole).withColumn("top", F.greatest("top", F.lit(float(head)))).where(F.col("bottom") - F.col("top") > least_band)
    boxes = covered.where("y IS NOT NULL AND h IS NOT NULL").select(*by, F.col("y").cast("double").alias("a"), (F.col("y") + F.col("h")).cast("double").alias("b"))
    # an interval is cut to the bands that it meets; the ends of a band are intervals of no length
    met = cut.join(boxes, by).where((F.col("a") < F.col("bottom")) & (F.col("b") > F.col("top")))
    inside = met.select(*by, "band", F.greatest("a", "top").alias("a"), F.least("b", "bottom").alias("b"))
    ends = cut.select(*by, "band", F.explode(F.array(F.struct(F.col("top").alias("a"), F.col("top").alias("b")), F.struct(F.col("bottom").alias("a"), F.col("bottom").alias("b")))).alias("e")).select(*by, "band", "e.*")
    along = Window.partitionBy(*by, "band").orderBy("a", "b")
    before = F.max("b").over(along.rowsBetween(Window.unboundedPreceding, -1))
    free = inside.unionByName(ends).withColumn("from", before).where(F.col("a") > F.col("from")).select(*by, "band", F.col("from"), F.col("a").alias("to"))
    order = Window.partitionBy(*by, "band").orderBy("from")
    begins = F.coalesce(F.col("from") - F.lag("to").over(order) >= gap, F.lit(True))
    run = free.withColumn("run", F.sum(begins.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    joined = run.groupBy(*by, "band", "run").agg(F.min("from").alias("y"), (F.max("to") - F.min("from")).alias("h"))
    return joined.where(F.col("h") >= least).select(*by, "band", "y", "h")
