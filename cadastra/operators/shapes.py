"""Shapes on bitmaps: runs of pixels united to shapes, their profiles, and the alifs among them with their marks.

A bitmap is an array of lines of '#' and other characters. Nothing here looks at single pixels: a line is cut into runs, which
take the labels of the runs that they touch on the line above; labels that meet are one shape.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.operators.storage import kept
from cadastra.operators.transcribe import standing_alifs


def _runs_of(line: Column) -> Column:
    """The runs of '#' of a line: an array of (x0, x1)."""
    pieces = F.regexp_extract_all(line, F.lit("#+|[^#]+"), F.lit(0))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<x0:int,x1:int>>").alias("runs"))

    def add(acc: Column, piece: Column) -> Column:
        end = acc["at"] + F.length(piece)
        run = F.struct(acc["at"].alias("x0"), (end - 1).alias("x1"))
        return F.struct(end.alias("at"), F.when(piece.startswith("#"), F.array_append(acc["runs"], run)).otherwise(acc["runs"]).alias("runs"))

    return F.aggregate(F.filter(pieces, lambda p: p != ""), start, add)["runs"]


_RUN, _STACK = "struct<x0:int,x1:int,label:int>", "struct<top:int,bottom:int,x0:int,x1:int,label:int>"
_STATE = f"struct<last:array<{_RUN}>,next:int,stacks:array<{_STACK}>,merged:array<struct<label:int,into:int>>>"


def _blocks(rows: Column) -> Column:
    """Equal lines that follow each other, as (line, top, bottom): their runs are the same and touch only themselves."""
    text = F.transform(rows, lambda line: F.coalesce(line, F.lit("")))
    starts = lambda t: F.filter(F.transform(t, lambda line, i: F.when((i == 0) | (line != F.get(t, i - 1)), i)), lambda i: i.isNotNull())
    cut = lambda t, at: F.transform(at, lambda i, k: F.struct(F.get(t, i).alias("line"), i.alias("top"), (F.coalesce(F.get(at, k + 1), F.size(t)) - 1).alias("bottom")))
    return F.flatten(F.transform(F.array(text), lambda t: F.flatten(F.transform(F.array(starts(t)), lambda at: cut(t, at)))))


def _labelled(state: Column, run: Column) -> Column:
    """``state`` (above, here, next, merged) with a run of the present line: the least label above that it touches, or a new
    one. Of labels that meet in it the greater ones are renamed and noted; none of them is seen again."""
    touching = F.array_distinct(F.transform(F.filter(state["above"], lambda p: (p["x0"] <= run["x1"] + 1) & (p["x1"] >= run["x0"] - 1)), lambda p: p["label"]))

    def placed(met: Column) -> Column:
        label = F.coalesce(F.array_min(met), state["next"])
        own = F.struct(run["x0"].alias("x0"), run["x1"].alias("x1"), label.alias("label"))
        renamed = lambda runs: F.when(F.size(met) < 2, runs).otherwise(F.transform(runs, lambda p: F.struct(p["x0"].alias("x0"), p["x1"].alias("x1"), F.when(F.array_contains(met, p["label"]), label).otherwise(p["label"]).alias("label"))))
        gone = F.transform(F.filter(met, lambda m: m != label), lambda m: F.struct(m.alias("label"), label.alias("into")))
        merged = F.when(F.size(met) < 2, state["merged"]).otherwise(F.concat(state["merged"], gone))
        return F.struct(renamed(state["above"]).alias("above"), F.array_append(renamed(state["here"]), own).alias("here"), (state["next"] + F.when(F.size(met) == 0, 1).otherwise(0)).alias("next"), merged.alias("merged"))

    return F.transform(F.array(touching), placed)[0]


def _stacks(rows: Column) -> Column:
    """The runs of a bitmap's blocks of lines, as (top, bottom, x0, x1, label): runs of a shape share its label, and labels
    rise with the shapes' first pixels, line by line."""
    line_state = f"struct<above:array<{_RUN}>,here:array<{_RUN}>,next:int,merged:array<struct<label:int,into:int>>>"

    def add(state: Column, block: Column) -> Column:
        start = F.struct(state["last"].alias("above"), F.array().cast(f"array<{_RUN}>").alias("here"), state["next"].alias("next"), state["merged"].alias("merged")).cast(line_state)
        line = lambda seen: F.struct(seen["here"].alias("last"), seen["next"].alias("next"), F.concat(state["stacks"], F.transform(seen["here"], lambda r: F.struct(block["top"].alias("top"), block["bottom"].alias("bottom"), r["x0"].alias("x0"), r["x1"].alias("x1"), r["label"].alias("label")))).alias("stacks"), seen["merged"].alias("merged")).cast(_STATE)
        return F.aggregate(_runs_of(block["line"]), start, lambda s, r: _labelled(s, r).cast(line_state), line)

    empty = F.struct(F.array().alias("last"), F.lit(0).alias("next"), F.array().alias("stacks"), F.array().alias("merged")).cast(_STATE)

    def settled(state: Column) -> Column:
        # each label with what it was merged into, or itself; then twice as far with each round
        own = F.transform(F.sequence(F.lit(0), state["next"]), lambda i: F.struct(i.alias("label"), i.alias("into")))
        both = lambda e: F.transform(F.filter(F.transform(e, lambda x, i: F.when((i == 0) | (x["label"] != F.get(e, i - 1)["label"]), x)), lambda x: x.isNotNull()), lambda x: x["into"])
        into = F.transform(F.array(F.array_sort(F.concat(state["merged"], own))), both)[0]
        rounds = F.when(F.size(state["merged"]) > 0, F.sequence(F.lit(0), F.ceil(F.log2(F.size(state["merged"]) + 1)).cast("int"))).otherwise(F.array().cast("array<int>"))
        ends = F.aggregate(rounds, into, lambda p, _: F.transform(p, lambda i: F.get(p, i)))
        return F.transform(F.array(ends), lambda p: F.transform(state["stacks"], lambda r: F.struct(r["top"].alias("top"), r["bottom"].alias("bottom"), r["x0"].alias("x0"), r["x1"].alias("x1"), F.get(p, r["label"]).alias("label"))))[0]

    return F.aggregate(_blocks(rows), empty, add, settled)


def labelled_runs(bitmaps: DataFrame) -> DataFrame:
    """(bitmap, id, top, bottom, x0, x1, shape, lines, wide) of every run of bitmaps (id, rows).

    A run that equal lines repeat is one row, from ``top`` to ``bottom``. ``bitmap`` numbers the rows of the table, so rows
    that share an id are bitmaps of their own; ``shape`` numbers a bitmap's 8-connected shapes from 0 by their first pixels,
    line by line; ``lines`` and ``wide`` are the bitmap's size. Null rows and empty bitmaps have no runs. A bitmap is labelled where
    its row is, line after line; its runs are shuffled once.
    """
    numbered = bitmaps.select(F.monotonically_increasing_id().alias("bitmap"), "id", "rows").where(F.size("rows") > 0)
    stacks = numbered.select("bitmap", "id", F.size("rows").alias("lines"), F.length(F.get("rows", F.lit(0))).alias("wide"), F.explode(_stacks(F.col("rows"))).alias("r"))
    shape = (F.dense_rank().over(Window.partitionBy("bitmap").orderBy("label")) - 1).cast("long")
    return stacks.select("bitmap", "id", "lines", "wide", "r.*").select("bitmap", "id", "top", "bottom", "x0", "x1", shape.alias("shape"), "lines", "wide")


def _boxes(runs: DataFrame) -> DataFrame:
    """(bitmap, id, shape, pixels, left, right, top, bottom, lines, wide)."""
    pixels = (F.col("x1") - F.col("x0") + 1).cast("long") * (F.col("bottom") - F.col("top") + 1)
    size = [F.sum(pixels).alias("pixels"), F.min("x0").alias("left"), F.max("x1").alias("right"), F.min("top").alias("top"), F.max("bottom").alias("bottom")]
    return runs.groupBy("bitmap", "id", "shape", "lines", "wide").agg(*size)


def components(bitmaps: DataFrame) -> DataFrame:
    """(id, shape, pixels, x, y, width, height) of each 8-connected shape of bitmaps (id, rows: array of lines)."""
    wide, high = F.col("right") - F.col("left") + 1, F.col("bottom") - F.col("top") + 1
    long_ = lambda c, name: c.cast("long").alias(name)
    return _boxes(labelled_runs(bitmaps)).select("id", "shape", "pixels", long_(F.col("left"), "x"), long_(F.col("top"), "y"), long_(wide, "width"), long_(high, "height"))


def profiles(runs: DataFrame) -> DataFrame:
    """(bitmap, shape, widths): of each line of a shape, from its top, how far its first and last pixel lie apart."""
    blocks = runs.groupBy("bitmap", "shape", "top", "bottom").agg((F.max("x1") - F.min("x0") + 1).alias("width"))
    ordered = F.array_sort(F.collect_list(F.struct("top", "bottom", "width")))
    return blocks.groupBy("bitmap", "shape").agg(F.flatten(F.transform(ordered, lambda b: F.array_repeat(b["width"], b["bottom"] - b["top"] + 1))).alias("widths"))


@dataclass(frozen=True)
class Type:
    """Sizes of a type at a scan's resolution, in pixels. The defaults are fixed values of the scans that the survey describes
    (Appendix C): stems are tall and thin, marks are small and lie close."""

    stem_height: int = 22
    stem_width: int = 15
    thin: int = 8
    thin_share: float = 0.6
    stem_from: float = 0.4
    stem_to: float = 0.85
    head: int = 14
    cap: int = 3  # lines of a flat cap, and how much wider than the stem it is
    mark_height: int = 14
    mark_width: int = 15
    mark_pixels: int = 20
    aside: int = 3
    above: int = 8
    flat: float = 1.6
    flat_width: int = 6
    below: int = 10
    foot: int = 9
    foot_pixels: int = 50


def head_kind(widths: Column, stem: Column, size: Type = Type()) -> Column:
    """'madda', 'hamza', 'bare' or 'unclear' by how an alif widens from its top.

    A madda is wide on one of the first lines and has a neck soon after; a hamza is narrow on them and has a bulge of at
    least three lines further down; without a wide line it is bare.
    """
    padded = F.slice(F.concat(F.slice(widths, 1, size.head), F.array_repeat(F.lit(0), size.head)), 1, size.head)
    wide = F.transform(padded, lambda w: w >= stem + size.cap)
    first = F.array_position(wide, True) - 1  # -1 if none is
    top = F.array_max(F.slice(padded, 1, size.cap))
    neck = F.array_min(F.filter(padded, lambda w, i: (i >= first + 2) & (i < first + 7)))
    bulge = F.size(F.filter(wide, lambda w, i: w & (i >= size.cap) & (i < size.head - 2)))
    bare = (first < 0) | (first >= size.head - 2)
    madda = (first < size.cap) & (top >= stem + size.cap) & (neck <= stem)
    hamza = (first >= size.cap) & (top <= stem + size.cap - 1) & (bulge >= 3)
    return F.when(bare, "bare").when(madda, "madda").when(hamza, "hamza").otherwise("unclear")


def alifs(bitmaps: DataFrame, size: Type = Type()) -> DataFrame:
    """(bitmap, id, shape, x, kind, below, stem) of the standing alifs of bitmaps of lines of text.

    Shapes that touch the upper or lower edge, or span the line, are no letters. An alif is tall and mostly thin; its
    stem is the median width of the lines from 40 to 85 % of its height. Marks are small shapes beside none of its sides: the
    first one just above a bare alif is a flat madda or else a hamza, a large one under its foot a hamza below. Marks
    and alifs of a bitmap meet in a join by bitmap; a line of text has few of either.
    """
    runs = kept(labelled_runs(bitmaps))
    high, wide = F.col("bottom") - F.col("top") + 1, F.col("right") - F.col("left") + 1
    boxes = _boxes(runs).where((F.col("top") > 0) & (F.col("bottom") < F.col("lines") - 1) & (high < 0.9 * F.col("lines")) & (wide < 0.8 * F.col("wide")))
    n = F.size("widths")
    low = F.floor(size.stem_from * n).cast("int")
    inner = F.array_sort(F.slice("widths", low + 1, F.greatest(low + 1, F.floor(size.stem_to * n).cast("int")) - low))
    m = F.size(inner)
    median = (F.get(inner, F.floor((m - 1) / 2).cast("int")) + F.get(inner, F.floor(m / 2).cast("int"))) / 2
    tall = boxes.where((high >= size.stem_height) & (wide <= size.stem_width)).join(profiles(runs), ["bitmap", "shape"])
    tall = tall.where(F.size(F.filter("widths", lambda w: w <= size.thin)) >= size.thin_share * n).withColumn("stem", median)
    tall = tall.withColumn("head", head_kind(F.col("widths"), F.col("stem"), size))

    marks = boxes.where((high <= size.mark_height) & (wide <= size.mark_width) & (F.col("pixels") >= size.mark_pixels))
    marks = marks.select("bitmap", F.col("shape").alias("mark"), F.col("pixels").alias("m_pixels"), *(F.col(c).alias(f"m_{c}") for c in ("left", "right", "top", "bottom")))
    near = tall.join(marks, "bitmap").where((F.col("mark") != F.col("shape")) & (F.col("m_right") >= F.col("left") - size.aside) & (F.col("m_left") <= F.col("right") + size.aside))
    m_high, m_wide = F.col("m_bottom") - F.col("m_top") + 1, F.col("m_right") - F.col("m_left") + 1
    gap = F.col("top") - F.col("m_bottom")
    over = (F.col("head") == "bare") & (gap >= -2) & (gap <= size.above)
    flat = F.when((m_wide >= size.flat * m_high) & (m_wide >= size.flat_width), "madda").otherwise("hamza")
    under = (F.col("m_top") - F.col("bottom") + 2).between(0, size.below) & (m_high >= size.foot) & (m_wide >= size.foot) & (F.col("m_pixels") >= size.foot_pixels)
    marked = near.groupBy("bitmap", "shape").agg(F.min_by(F.when(over, flat), F.when(over, F.col("mark"))).alias("over"), F.max(under & ~over).alias("below"))
    found = tall.join(marked, ["bitmap", "shape"], "left")
    return found.select("bitmap", "id", "shape", ((F.col("left") + F.col("right")) / 2).alias("x"), F.coalesce("over", "head").alias("kind"), F.coalesce("below", F.lit(False)).alias("below"), "stem")


#: What the head of each alif looks like (fixed values of the script): bare, madda and hamza above; a hamza below has a bare head.
HEADS = {"ا": "bare", "أ": "hamza", "إ": "bare", "آ": "madda"}
BELOW = "إ"


def verdicts(bitmaps: DataFrame, size: Type = Type()) -> DataFrame:
    """(id, alifs, found, verdict) of bitmaps (id, rows, text) of single names: null where the scan agrees with the text.

    A name's standing alifs are matched with the scan's from right to left. ``count``: there are more of one; ``below 2``: at
    the second alif a mark under the foot is there or isn't against the text; ``head 2 hamza``: its head is another, and
    looks so. Unclear heads agree with all. Names without text have no alifs. Each row of the table has its verdict.
    """
    names = kept(bitmaps.select("id", "rows", "text", F.monotonically_increasing_id().alias("n")))
    seen = alifs(names.select(F.col("n").alias("id"), "rows"), size)
    order = F.array_sort(F.collect_list(F.struct((-F.col("x")).alias("x"), "shape", "kind", "below")))
    lines = seen.groupBy(F.col("id").alias("n")).agg(order.alias("marks"))
    rows = names.join(lines, "n", "left")
    none = F.array().cast("array<struct<x:double,shape:bigint,kind:string,below:boolean>>")
    rows = rows.select("id", standing_alifs(F.coalesce("text", F.lit(""))).alias("letters"), F.coalesce("marks", none).alias("marks"))
    head = F.create_map(*(F.lit(x) for kv in HEADS.items() for x in kv))

    def judged(mark: Column, i: Column) -> Column:
        letter, place = F.get("letters", i), (i + 1).cast("string")
        against = (mark["kind"] != "unclear") & (mark["kind"] != head[letter])
        return F.when((letter == BELOW) != mark["below"], F.concat(F.lit("below "), place)).when(against, F.concat(F.lit("head "), place, F.lit(" "), mark["kind"]))

    wrong = F.get(F.filter(F.transform("marks", judged), lambda v: v.isNotNull()), F.lit(0))
    verdict = F.when(F.size("letters") != F.size("marks"), "count").otherwise(wrong)
    return rows.select("id", F.size("letters").alias("alifs"), F.size("marks").alias("found"), verdict.alias("verdict"))
