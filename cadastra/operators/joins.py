"""Joins beyond equality: either-key, exactly-one, as-of, bands, boxes, nearest, positional, overrides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.operators.checks import require_none
from cadastra.operators.names import fresh
from cadastra.operators.similar import best_matches
from cadastra.operators.storage import kept


def last_wins(frame: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The last row of each key. One aggregation, combined before the shuffle; equal order is broken by the row itself.
    Null keys are one key, a null order is the first; an empty table gives no rows."""
    rest, (row,) = [c for c in frame.columns if c not in keys], fresh(frame, "_row")
    best = frame.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order, *rest)).alias(row))
    return best.select(*keys, *(F.col(f"{row}.`{c}`").alias(c) for c in rest))


def either_key(left: DataFrame, right: DataFrame, id_left: str, id_right: str, keys: list[tuple[str, str]]) -> DataFrame:
    """(id_left, id_right): pairs in which at least one of ``keys`` is equal, each once. Null keys match nothing; other columns
    are not looked at. The two ids have names of their own.

    A join with OR would compare every row with every row; this is one equality join for each key.
    """
    (key,) = fresh([id_left, id_right], "_key")
    found = None
    for a, b in keys:
        x = left.where(F.col(a).isNotNull()).select(id_left, F.col(a).alias(key))
        y = right.where(F.col(b).isNotNull()).select(id_right, F.col(b).alias(key))
        pairs = x.join(y, key).select(id_left, id_right)
        found = pairs if found is None else found.unionByName(pairs)
    return found.distinct()


def either_key_counts(left: DataFrame, right: DataFrame, id_left: str, id_right: str, keys: list[tuple[str, str]], *, apart: bool = False) -> DataFrame:
    """(id_left, ``matches``, ``least``): of each id of ``left`` how many ids of ``right`` agree with it in one of two ``keys``, and the
    least of them; ids that none agrees with are left out. ``apart``: an id's match with itself doesn't count.

    No pairs are made, whose number grows with the square of a key's rows: an id matches as many as have the first key, and the
    second, less those that have both. Ids may repeat: an id of ``right`` has all its rows' keys. Ids of ``left`` that have
    several keys of a kind, which repeated ids alone can have, meet their partners in pairs. Null keys match nothing, null ids are no rows.
    """
    (a, b), (c, d) = keys
    both = right.where(F.col(id_right).isNotNull()).groupBy(F.col(id_right).alias("_r")).agg(F.collect_set(b).alias("_b"), F.collect_set(d).alias("_d"))
    first, second = both.select("_r", F.explode("_b").alias("_x")), both.select("_r", F.explode("_d").alias("_y"))
    crossed = both.select("_r", F.explode("_b").alias("_x"), "_d").select("_x", F.explode("_d").alias("_y"))

    def summed(rows: DataFrame, key: str) -> DataFrame:
        groups = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min("_r").alias("one"))
        if apart:  # the least but for the first, for the row that is the first itself
            others = rows.join(groups.select(key, "one"), key).where("_r > one").groupBy(key).agg(F.min("_r").alias("two"))
            groups = groups.join(others, key, "left")
        return groups.select(key, *(F.col(x).alias(f"{x}{key}") for x in ("n", "one", *(["two"] if apart else []))))

    ids = left.where(F.col(id_left).isNotNull()).groupBy(F.col(id_left).alias("_l")).agg(F.collect_set(a).alias("_a"), F.collect_set(c).alias("_c"))
    plain = (F.size("_a") < 2) & (F.size("_c") < 2)
    rows = ids.where(plain).select("_l", F.get("_a", F.lit(0)).alias("_x"), F.get("_c", F.lit(0)).alias("_y"))
    rows = rows.join(summed(first, "_x"), "_x", "left").join(summed(second, "_y"), "_y", "left")
    rows = rows.join(crossed.groupBy("_x", "_y").agg(F.count(F.lit(1)).alias("_both")), ["_x", "_y"], "left")
    number = lambda n: F.coalesce(n, F.lit(0))
    matches, least = number("n_x") + number("n_y") - number("_both"), F.least("one_x", "one_y")
    if apart:
        rows = rows.join(both.withColumnRenamed("_r", "_own"), F.col("_own") == F.col("_l"), "left")
        own = F.coalesce(F.array_contains("_b", F.col("_x")), F.lit(False)) | F.coalesce(F.array_contains("_d", F.col("_y")), F.lit(False))
        other = lambda k: F.when(F.col(f"one{k}") == F.col("_l"), F.col(f"two{k}")).otherwise(F.col(f"one{k}"))
        matches, least = matches - own.cast("long"), F.least(other("_x"), other("_y"))
    counted = rows.select(F.col("_l").alias(id_left), matches.alias("matches"), least.alias("least")).where("matches > 0")

    several = ids.where(~plain)
    sides = [several.select("_l", F.explode(x).alias("_k")).join(f.withColumnRenamed(k, "_k"), "_k").select("_l", "_r") for x, f, k in (("_a", first, "_x"), ("_c", second, "_y"))]
    pairs = sides[0].unionByName(sides[1]).where(F.col("_l") != F.col("_r") if apart else F.lit(True)).distinct()
    return counted.unionByName(pairs.groupBy(F.col("_l").alias(id_left)).agg(F.count(F.lit(1)).alias("matches"), F.min("_r").alias("least")))


def match_counts(left: DataFrame, right: DataFrame, id_left: str, id_right: str, keys: list[tuple[str, str]], *, grouped: bool = False) -> DataFrame:
    """id_left, ``matches`` and ``match`` (the one partner, null if there are none or several). ``grouped``: by ``either_key_counts``, for
    keys that many rows may share; where nearly all rows have keys of their own, pairs take fewer shuffles."""
    if grouped:
        counted = either_key_counts(left, right, id_left, id_right, keys).withColumnRenamed("least", "match")
    else:
        pairs = either_key(left, right, id_left, id_right, keys)
        counted = pairs.groupBy(id_left).agg(F.count(F.lit(1)).alias("matches"), F.min(id_right).alias("match"))
    joined = left.select(id_left).join(counted, id_left, "left")
    return joined.select(id_left, F.coalesce("matches", F.lit(0)).alias("matches"), F.when(F.col("matches") == 1, F.col("match")).alias("match"))


def exactly_one(left: DataFrame, right: DataFrame, id_left: str, id_right: str, keys: list[tuple[str, str]], what: str) -> DataFrame:
    """(id_left, id_right) with one partner for each row of ``left``; else an IntegrityError. Partners are counted once, not anew
    for the check and for each use of the pairs."""
    counted = kept(match_counts(left, right, id_left, id_right, keys))
    require_none(counted.where("matches <> 1"), f"{what}: not exactly one match")
    return counted.select(id_left, F.col("match").alias(id_right))


def bijection(left: DataFrame, right: DataFrame, id_left: str, id_right: str, keys: list[tuple[str, str]], what: str) -> DataFrame:
    """``exactly_one`` both ways: no two rows share a partner and no row of ``right`` is left over."""
    pairs = exactly_one(left, right, id_left, id_right, keys, what)
    require_none(pairs.groupBy(id_right).count().where("count > 1"), f"{what}: two rows share a partner")
    require_none(right.select(id_right).join(pairs, id_right, "left_anti"), f"{what}: rows left over")
    return pairs


def as_of(left: DataFrame, right: DataFrame, on: str, by: list[str], values: list[str]) -> DataFrame:
    """``left`` with ``values`` of the last row of ``right`` whose ``on`` is not after; null where there is none.

    One shuffle by ``by``: both sides in a union, the last seen value carried along. Of equal ``on`` in ``right`` the
    largest values count. Null keys are a group like others, unlike in a join; a row of ``left`` without a place has
    no values, and one of ``right`` is none. Rows that repeat each other stay; the new columns are named ``<value>_as_of``.
    """
    at, side, row, value, last = fresh(by, "_at", "_side", "_row", "_value", "_last")
    taken = F.struct(*(F.col(v).alias(v) for v in values))
    shape = right.select(taken.alias("s")).schema["s"].dataType
    rows = left.select(*by, F.col(on).alias(at), F.lit(1).alias(side), F.struct(*left.columns).alias(row), F.lit(None).cast(shape).alias(value))
    marks = right.where(F.col(on).isNotNull()).select(*by, F.col(on).alias(at), F.lit(0).alias(side), F.lit(None).cast(rows.schema[row].dataType).alias(row), taken.alias(value))
    order = Window.partitionBy(*by).orderBy(at, side, value).rowsBetween(Window.unboundedPreceding, 0)
    carried = rows.unionByName(marks).withColumn(last, F.last(value, ignorenulls=True).over(order)).where(F.col(side) == 1)
    return carried.select(*(F.col(f"{row}.`{c}`").alias(c) for c in left.columns), *(F.col(f"{last}.`{v}`").alias(f"{v}_as_of") for v in values))


def bands(rules: DataFrame, by: list[str], at: str, *, low: float, high: float, least: float) -> DataFrame:
    """Bands (by, band, top, bottom) between the rules of a page, from ``low`` to ``high``; narrow ones are left out.

    ``band`` counts all bands from 0, so it is the number of rules at or above a place. A rule without a place is none, and
    pages without rules have no bands. One shuffle by page: each rule ends a band, the last begins one as well.
    """
    y, order = F.col(at).cast("double"), Window.partitionBy(*by).orderBy("_y")
    rows = rules.where(F.col(at).isNotNull()).select(*by, y.alias("_y"))
    rows = rows.select(*by, "_y", F.row_number().over(order).alias("_n"), F.coalesce(F.lag("_y").over(order), F.lit(float(low))).alias("_top"), F.lead("_y").over(order).isNull().alias("_last"))
    band = lambda n, top, bottom: F.struct(n.alias("band"), top.alias("top"), bottom.alias("bottom"))
    above, below = band(F.col("_n") - 1, F.col("_top"), F.col("_y")), band(F.col("_n"), F.col("_y"), F.lit(float(high)))
    cut = rows.select(*by, F.explode(F.when(F.col("_last"), F.array(above, below)).otherwise(F.array(above))).alias("_b"))
    return cut.select(*by, "_b.band", "_b.top", "_b.bottom").where(F.col("bottom") - F.col("top") > least)


def into_bands(boxes: DataFrame, cut: DataFrame, by: list[str], middle: str) -> DataFrame:
    """``boxes`` with the band that holds ``middle``; bands tile a page, so an as-of lookup finds it."""
    found = as_of(boxes, cut.withColumn(middle, F.col("top")), middle, by, ["band", "top", "bottom"])
    inside = F.col(middle) < F.col("bottom_as_of")
    return found.select(*boxes.columns, *(F.when(inside, F.col(f"{c}_as_of")).alias(c) for c in ("band", "top", "bottom")))


def overlapping(a: DataFrame, b: DataFrame, by: list[str], *, high: float = 0.5, wide: float = 0.3, cell: float = 0.05) -> DataFrame:
    """Pairs of boxes (x, y, w, h) of a page that overlap by a share of the smaller height and width.

    Pairs meet in horizontal strips of ``cell``, in the first that both touch, so that a page's boxes are not all
    compared. Columns: those of ``by``, then a_id and b_id.
    """
    def strips(f, name):
        cells = F.sequence(F.floor(F.col("y") / cell), F.floor((F.col("y") + F.col("h")) / cell))
        return f.select(*by, F.struct("id", "x", "y", "w", "h").alias(name), F.explode(cells).alias("_cell"))

    met = strips(a, "a").join(strips(b, "b"), [*by, "_cell"])
    first = F.greatest(F.floor(F.col("a.y") / cell), F.floor(F.col("b.y") / cell))
    dy = F.least(F.col("a.y") + F.col("a.h"), F.col("b.y") + F.col("b.h")) - F.greatest("a.y", "b.y")
    dx = F.least(F.col("a.x") + F.col("a.w"), F.col("b.x") + F.col("b.w")) - F.greatest("a.x", "b.x")
    ok = (F.col("_cell") == first) & (dy > high * F.least("a.h", "b.h")) & (dx > wide * F.least("a.w", "b.w"))
    return met.where(ok).select(*by, F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id"))


def within(inner: Column, outer: Column, slack: float = 0.004, high: float = 0.7) -> Column:
    """Whether a box (a struct of x, y, w, h) lies in another's height, by a small slack, is clearly less high, and has its
    middle between the other's sides."""
    middle = inner["x"] + inner["w"] / 2
    tall = (inner["y"] >= outer["y"] - slack) & (inner["y"] + inner["h"] <= outer["y"] + outer["h"] + slack) & (inner["h"] < high * outer["h"])
    return tall & (middle > outer["x"]) & (middle < outer["x"] + outer["w"])


def boxes_within(inner: DataFrame, outer: DataFrame, by: list[str], *, slack: float = 0.004, high: float = 0.7, cell: float = 0.05) -> DataFrame:
    """Pairs (inner_id, outer_id) of a page's boxes of which one lies ``within`` the other; they meet in strips."""
    top = F.floor(F.col("y") / cell)
    small = inner.select(*by, F.struct("id", "x", "y", "w", "h").alias("_in"), top.alias("_cell"))
    strips = F.sequence(F.floor((F.col("y") - slack) / cell), F.floor((F.col("y") + F.col("h") + slack) / cell))
    large = outer.select(*by, F.struct("id", "x", "y", "w", "h").alias("_out"), F.explode(strips).alias("_cell"))
    met = small.join(large, [*by, "_cell"]).where(within(F.col("_in"), F.col("_out"), slack, high))
    return met.select(F.col("_in.id").alias("inner_id"), F.col("_out.id").alias("outer_id"))


def nearest_within(left: DataFrame, right: DataFrame, by: list[str], at: str, reach: float) -> DataFrame:
    """Pairs (l_id, r_id) of a page whose places differ by less than ``reach``, joined over cells of that size."""
    x = left.select(*by, F.col("id").alias("l_id"), F.col(at).alias("_l"), F.explode(F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda d: F.floor(F.col(at) / reach) + d)).alias("_cell"))
    y = right.select(*by, F.col("id").alias("r_id"), F.col(at).alias("_r"), F.floor(F.col(at) / reach).alias("_cell"))
    return x.join(y, [*by, "_cell"]).where(F.abs(F.col("_l") - F.col("_r")) < reach).select(*by, "l_id", "r_id")


def numbered(frame: DataFrame, by: list[str], order: list[Column | str], name: str = "position") -> DataFrame:
    return frame.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def positional(left: DataFrame, right: DataFrame, by: list[str], order_left: list, order_right: list, *, complete: bool = True) -> DataFrame:
    """Rows of equal number in their group, side by side; if ``complete``, counts that differ are an IntegrityError."""
    a, b = numbered(left, by, order_left), numbered(right, by, order_right)
    joined = a.withColumn("_a", F.lit(1)).join(b.withColumn("_b", F.lit(1)), [*by, "position"], "full_outer")
    if complete:
        require_none(joined.where("_a IS NULL OR _b IS NULL").select(*by, "position"), "editions of different length")
    return joined.drop("_a", "_b")


def with_gaps(frame: DataFrame, gaps: DataFrame, by: list[str], position: str) -> DataFrame:
    """``frame`` with empty rows at the positions of ``gaps``; later rows move on by the gaps before them."""
    rows = frame.join(gaps.groupBy(*by).agg(F.array_sort(F.collect_list(position)).alias("_gaps")), by, "left")
    place = F.aggregate(F.coalesce("_gaps", F.array().cast("array<int>")), F.col(position), lambda p, g: F.when(g <= p, p + 1).otherwise(p))
    return rows.withColumn(position, place.cast("int")).drop("_gaps").unionByName(gaps.select(*by, position), allowMissingColumns=True)


def between_neighbours(rows: DataFrame, by: list[str], order: str, partner: str) -> DataFrame:
    """``rows`` with low and high: the partners of the nearest rows before and after that have one."""
    w = Window.partitionBy(*by).orderBy(order)
    return rows.withColumn("low", F.last(partner, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))).withColumn(
        "high", F.first(partner, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    )


def overridden(frame: DataFrame, readings: DataFrame, keys: list[str], column: str, reading: str, *, blank_counts: bool = False) -> DataFrame:
    """``column`` replaced by a reading where there is one, with ``check`` 'eye' there. Blank readings count if asked. Of several
    readings the largest holds; null keys have none; a null reading is none."""
    (seen,) = fresh([*frame.columns, *keys], "_reading")
    given = last_wins(readings.select(*keys, F.col(reading).alias(seen)), keys, [seen])
    usable = F.col(seen).isNotNull() if blank_counts else F.coalesce(F.col(seen) != "", F.lit(False))
    joined = frame.join(given, keys, "left")
    return joined.withColumn(column, F.when(usable, F.col(seen)).otherwise(F.col(column))).withColumn("check", F.when(usable, "eye").otherwise("")).drop(seen)


def respelled(column: Column, spellings: dict[str, str]) -> Column:
    """A constant map with identity elsewhere; maps are short and live in code, so they are literals of the plan."""
    if not spellings:
        return column
    table = F.create_map(*(F.lit(x) for kv in spellings.items() for x in kv))
    return F.coalesce(table[column], column)


def most_similar(left: DataFrame, right: DataFrame, by: list[str], text_left: str, text_right: str, cutoff: float) -> DataFrame:
    """``left`` with r_id and score of the most similar row of ``right`` in its group, if at least ``cutoff``; see ``similar``."""
    return best_matches(left, right, by, text_left, text_right, cutoff)


def prefixed(codes: DataFrame, entries: DataFrame, code: str, entry: str) -> DataFrame:
    """The least entry that starts with each code and a non-digit; equality on the leading digits, not a theta join."""
    lead = entries.withColumn("_code", F.regexp_extract(entry, "^([0-9]+)", 1))
    first = lead.where("_code <> ''").groupBy("_code").agg(F.min(entry).alias(entry))
    return codes.join(first, codes[code] == first["_code"], "left").drop("_code")
