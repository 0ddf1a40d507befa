"""Rows of a printed table of districts: a seat beside its members, from lines with boxes.

A line is a row (id, x, y, w, h, text) of a column of a page; the caller names the columns that tell columns apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.functions.text import at_least_similar, in_capitals, letters_only
from cadastra.operators.joins import as_of, numbered
from cadastra.operators.layout import owners
from cadastra.operators.sequence import clustered
from cadastra.operators.transcribe import doubt


def latin_seats(lines: DataFrame, *, inner: float = 0.16) -> DataFrame:
    """``lines`` with ``seat``: whether a line is one, in capitals or near the column's ``left`` edge (a column of ``lines``)."""
    near = F.col("x") + F.col("w") / 2 - F.col("left") < inner
    return lines.withColumn("seat", in_capitals(F.col("text")) | F.coalesce(near, F.lit(False)))


def arabic_seats(lines: DataFrame, by: list[str], *, dash: str = r"^\s*[-–—]", width: float = 0.32, over: float = 0.03, under: float = 0.02, cut: float = 0.015) -> DataFrame:
    """``lines`` with ``seat``: members end at the rule that parts them from the seats, the median right end of a table's
    lines with a dash, or ``width`` from the ``left`` edge; seats reach beyond it by ``over``.

    A line that a reader ran over the rule ("seat - member") is two: what precedes the dash is the seat, from ``cut``
    behind the rule; what follows is the member, up to it. The member's id is the line's, its seat's the line's as well.
    """
    right = F.col("x") + F.col("w")
    edges = lines.where(F.col("text").rlike(dash)).groupBy(*by).agg(F.median(right).alias("_edge"))
    rows = lines.join(edges, by, "left").withColumn("_edge", F.coalesce("_edge", F.col("left") + width))
    run_over = F.coalesce(F.col("text").contains(" - ") & (F.col("x") < F.col("_edge") - under) & (right > F.col("_edge") + over), F.lit(False))
    wall = F.col("_edge") + cut
    piece = lambda x, w, text, seat: F.struct(x.alias("x"), w.alias("w"), text.alias("text"), seat.alias("seat"))
    text = F.col("text")
    seat = piece(wall, right - wall, F.trim(F.substring_index(text, " - ", 1)), F.lit(True))
    member = piece(F.col("x"), wall - F.col("x"), F.concat(F.lit("- "), F.trim(F.substring(text, F.instr(text, " - ") + 3, F.length(text)))), F.lit(False))
    whole = piece(F.col("x"), F.col("w"), text, right > F.col("_edge") + over)
    rows = rows.withColumn("_piece", F.explode(F.when(run_over, F.array(seat, member)).otherwise(F.array(whole))))
    rest = [c for c in lines.columns if c not in ("x", "w", "text")]
    return rows.select(*rest, "_piece.x", "_piece.w", "_piece.text", "_piece.seat")


def district_rows(lines: DataFrame, rules: DataFrame, by: list[str], *, latin: bool, line: float = 0.006, level: float = 0.012, alike: float = 0.6) -> DataFrame:
    """(by, row, band, seat, members, doubt): the rows that ``lines`` (with ``seat``) make between ``rules`` (by, y).

    A band between two rules is a row. Where a rule is missing it holds several: a seat line that is level with a member
    line of nearly its name, and below the seat before it, begins another; other seat lines go on with the seat above.
    A line belongs to the row that begins last at or above its middle, lines ahead of all to the first. ``seat`` and ``members``
    are arrays of texts in reading order: lines from the top, pieces of a line along it. Rows count from 1 in a
    column of a page. ``doubt`` says why a row needs a look, see ``transcribe.doubt``. Lines without text or place, and null
    columns of a page, are left out; a column without lines has no rows.
    """
    shown = lines.where(F.col("text").isNotNull() & F.col("y").isNotNull()).dropna(subset=by).withColumn("middle", F.col("y") + F.col("h") / 2)
    cut = numbered(rules.where(F.col("y").isNotNull()).select(*by, F.col("y").alias("middle")), by, ["middle"], "band")
    placed = as_of(shown, cut, "middle", by, ["band"]).withColumn("band", F.coalesce("band_as_of", F.lit(0))).drop("band_as_of")
    band = [*by, "band"]
    read = clustered(placed, band, "y", line, "first").withColumnRenamed("cluster", "line")

    # where rows begin: the first seat of a band, and seats that a member of their name stands beside
    name = letters_only(F.col("text"), latin)
    seats = read.where("seat").select(*band, "id", "y", name.alias("a"))
    members = read.where("NOT seat").select(*band, F.col("y").alias("m_y"), name.alias("b"))
    level_ = seats.join(members, band).where((F.abs(F.col("y") - F.col("m_y")) < level) & (F.col("a") != "") & (F.col("b") != ""))
    named = level_.where(at_least_similar(alike)(F.col("a"), F.col("b"))).select(*band, "y")
    first = seats.groupBy(*band).agg(F.min("y").alias("y"))
    begins = clustered(named.unionByName(first).distinct(), band, "y", line, "first")
    starts = begins.groupBy(*band, "cluster").agg(F.min("y").alias("middle")).select(*band, "middle", F.col("cluster").alias("entry"))

    owned = owners(read, starts, band, "middle").withColumn("entry", F.coalesce("entry", F.lit(0)))
    along = F.col("x") if latin else -F.col("x")
    piece = F.struct("line", along.alias("along"), "id", "text")
    texts = lambda which: F.transform(F.array_sort(F.collect_list(F.when(which, piece))), lambda p: p["text"])
    rows = owned.groupBy(*band, "entry").agg(texts(F.col("seat")).alias("seat"), texts(~F.col("seat")).alias("members"))
    order = Window.partitionBy(*by).orderBy("band", "entry")
    return rows.select(*by, F.row_number().over(order).alias("row"), "band", "seat", "members", doubt(F.col("seat"), F.col("members"), latin).alias("doubt"))


def zipped(rows: DataFrame, by: list[str]) -> DataFrame:
    """(by, row, item, seat, name): a row of ``district_rows`` as lines of a table, item 1 and on its members, each beside the
    seat as one text; a row without members has one line, item 0."""
    seat = F.array_join("seat", " ")
    some = rows.where(F.size("members") > 0).select(*by, "row", seat.alias("seat"), F.posexplode("members").alias("at", "name"))
    none = rows.where(F.size("members") == 0).select(*by, "row", F.lit(0).alias("item"), seat.alias("seat"), F.lit(None).cast("string").alias("name"))
    return some.select(*by, "row", (F.col("at") + 1).alias("item"), "seat", "name").unionByName(none)
