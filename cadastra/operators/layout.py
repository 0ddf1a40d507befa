"""Layout of scanned pages: bitmaps, gutters, passes of readings, rows of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.operators.shapes import components  # noqa: F401  shapes are part of a page's layout

def profile(bitmaps: DataFrame) -> DataFrame:
    """(id, y, width): from the first to the last pixel of each line that has any, without Python."""
    lines = bitmaps.select("id", F.posexplode("rows").alias("y", "line"))
    first, last = F.instr("line", "#"), F.length("line") - F.instr(F.reverse("line"), "#") + 1
    return lines.where(first > 0).select("id", "y", (last - first + 1).alias("width"))


def stem_like(widths: DataFrame, *, least_height: int = 22, most_width: int = 15, thin: int = 8, share: float = 0.6) -> DataFrame:
    """(id, stem): of tall narrow shapes the median width of lines from 40 to 85 % of the height, else null."""
    size = widths.groupBy("id").agg(F.min("y").alias("top"), (F.max("y") - F.min("y") + 1).alias("height"), F.max("width").alias("wide"), F.avg((F.col("width") <= thin).cast("double")).alias("thin"))
    inner = widths.join(size, "id").where((F.col("y") - F.col("top") >= 0.4 * F.col("height")) & (F.col("y") - F.col("top") <= 0.85 * F.col("height")))
    stem = inner.groupBy("id").agg(F.median("width").alias("stem"))
    ok = (F.col("height") >= least_height) & (F.col("wide") <= most_width) & (F.col("thin") >= share)
    return size.join(stem, "id", "left").select("id", F.when(ok, F.col("stem")).alias("stem"))


def gutter(boxes: DataFrame, by: list[str], *, low: int = 400, high: int = 600, per: int = 1000, most_width: float = 0.6) -> DataFrame:
    """by and ``gutter``: the place between two columns of boxes (x, w).

    Places are ``low`` to ``high``, in parts of 1 / ``per`` of the page. Of the runs of places that fewest boxes cover, edges not
    counted, the one whose middle lies nearest the centre is the gutter, of two as near the left one. Boxes of
    ``most_width`` and more, as headings are, don't count. Groups without boxes have no row.
    """
    place = lambda k: k / F.lit(float(per))
    pages = boxes.select(*by).distinct().select(*by, F.explode(F.sequence(F.lit(low), F.lit(high))).alias("k"))
    # two places more on either side than the edges say, then exactly those strictly inside
    first = F.greatest(F.floor(F.col("x") * per).cast("int") - 1, F.lit(low))
    last = F.least(F.ceil((F.col("x") + F.col("w")) * per).cast("int") + 1, F.lit(high))
    near = boxes.where(F.col("w") < most_width).where(first <= last).select(*by, "x", "w", F.explode(F.sequence(first, last)).alias("k"))
    covered = near.where((place(F.col("k")) > F.col("x")) & (place(F.col("k")) < F.col("x") + F.col("w"))).groupBy(*by, "k").agg(F.count(F.lit(1)).alias("n"))
    counts = pages.join(covered, [*by, "k"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    free = counts.join(counts.groupBy(*by).agg(F.min("n").alias("least")), by).where("n = least")
    run = free.withColumn("run", F.col("k") - F.row_number().over(Window.partitionBy(*by).orderBy("k")))
    runs = run.groupBy(*by, "run").agg(F.min("k").alias("a"), F.max("k").alias("b"))
    middle = F.col("a") + F.col("b")  # twice, in parts
    return runs.groupBy(*by).agg((F.min_by(middle, F.struct(F.abs(middle - per), middle)) / (2.0 * per)).alias("gutter"))


def side(x: Column, w: Column, middle: Column | float = 0.5) -> Column:
    return F.when(x + w / 2 < middle, "left").otherwise("right")


#: Letters of the two editions.
ARABIC_LETTERS, LATIN_LETTERS = "\u0621-\u064A", "A-Za-z\u00C0-\u00FF\u0152\u0153"


def plausible(text: Column, h: Column, arabic: bool, least_height: float = 0.008) -> Column:
    """Whether a reading may be text of its edition: high enough, with two letters or more, all of the edition's own."""
    letters = F.regexp_replace(text, r"[^\p{L}]", "")
    return (h >= least_height) & letters.rlike(f"^[{ARABIC_LETTERS if arabic else LATIN_LETTERS}]{{2,}}$")


def merged_passes(passes: list[DataFrame], by: list[str], arabic: bool) -> DataFrame:
    """Readings (by, id, x, y, w, h, text) of the first pass, gaps filled from later ones, with ``alt``: the texts that
    later passes read at the same place.

    A box around two or more boxes of a later pass goes, as that pass reads its lines one by one. What a later pass alone
    has is taken if it is plausible. Ids are unique over all passes.
    """
    from cadastra.operators.joins import boxes_within, overlapping

    none = F.array().cast("array<string>")
    merged = passes[0].withColumn("alt", none)
    for later in passes[1:]:
        around = boxes_within(later, merged, by).groupBy(F.col("outer_id").alias("id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        merged = merged.join(around, "id", "left_anti").select(*merged.columns)
        met = overlapping(merged, later, by)
        texts = met.join(later.select(F.col("id").alias("b_id"), "text"), "b_id").groupBy("a_id").agg(F.array_sort(F.collect_list("text")).alias("_more"))
        alone = later.where(plausible(F.col("text"), F.col("h"), arabic)).join(met.select(F.col("b_id").alias("id")).distinct(), "id", "left_anti")
        joined = merged.join(texts, merged["id"] == texts["a_id"], "left").drop("a_id")
        merged = joined.withColumn("alt", F.concat("alt", F.coalesce("_more", none))).drop("_more").unionByName(alone.withColumn("alt", none).select(passes[0].columns + ["alt"]))
    return merged


def owners(lines: DataFrame, starts: DataFrame, by: list[str], middle: str) -> DataFrame:
    """``lines`` with the entry that starts last at or above their middle; those ahead of all belong to the first."""
    from cadastra.operators.joins import as_of

    first = starts.groupBy(*by).agg(F.min_by("entry", middle).alias("_first"))
    found = as_of(lines, starts, middle, by, ["entry"]).join(first, by, "left")
    return found.withColumn("entry", F.coalesce("entry_as_of", "_first")).drop("entry_as_of", "_first")


def hull(frame: DataFrame, by: list[str]) -> DataFrame:
    """The box around each group's boxes."""
    x, y = F.min("x"), F.min("y")
    return frame.groupBy(*by).agg(x.alias("x"), y.alias("y"), (F.max(F.col("x") + F.col("w")) - x).alias("w"), (F.max(F.col("y") + F.col("h")) - y).alias("h"))
