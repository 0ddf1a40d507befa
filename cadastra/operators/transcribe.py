"""From positioned readings to rows: printed code tables, numbered lists, two readings of a list reconciled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.functions.text import letters_only, squeezed
from cadastra.operators.checks import require_none, require_unique

def lines_of(characters: DataFrame, by: list[str], *, foot: float, line: float) -> DataFrame:
    """Characters (by, page, i, x, y, w, h, c) with ``line``: those whose middles follow each other within ``line``. A
    character that is there twice, as ligatures are, counts once; what lies from ``foot`` on, the running foot, is left
    out. Heights are shares of a page."""
    page = [*by, "page"]
    middle = F.col("y") + F.col("h") / 2
    shown = characters.where(middle < foot).groupBy(*page, "x", "y", "w", "h", "c").agg(F.min("i").alias("i")).withColumn("mid", middle)
    w = Window.partitionBy(*page).orderBy("mid", "i")
    begins = F.coalesce(F.col("mid") - F.lag("mid").over(w) >= line, F.lit(True))
    return shown.withColumn("line", F.sum(begins.cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def _word(characters: DataFrame, by: list[str], rtl: bool, name: str, gap: float) -> DataFrame:
    order = [F.desc("x") if rtl else F.asc("x"), F.asc("i")]
    w = Window.partitionBy(*by).orderBy(*order)
    apart = (F.lag("x").over(w) - (F.col("x") + F.col("w"))) if rtl else (F.col("x") - (F.lag("x").over(w) + F.lag("w").over(w)))
    rows = characters.withColumn("_place", F.row_number().over(w)).withColumn("_c", F.concat(F.when(apart > gap, " ").otherwise(""), "c"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_place", "_c"))), lambda r: r["_c"]), "")
    return rows.groupBy(*by).agg(F.trim(F.regexp_replace(text, "ـ", "")).alias(name))


def code_rows(characters: DataFrame, by: list[str], *, furniture: str, foot: float, line: float, gap: float) -> DataFrame:
    """(by, page, line, province, code, fr, ar) of printed tables of codes, one for each document (``by``).

    One or two digits on a line are a heading, four are a row: its code, the French name to the left of the digits and
    the Arabic one to the right; characters more than ``gap`` apart are words. Lines like ``furniture`` are no part of the
    table. A row under another heading, and a code that a document prints twice, are errors.
    """
    rows = lines_of(characters, by, foot=foot, line=line).withColumn("digit", F.col("c").rlike("^[0-9]$"))
    place, where = F.struct("x", "c"), [*by, "page", "line"]
    text = lambda items: F.array_join(F.array_sort(items).getField("c"), "")
    numbers = F.when(F.col("digit"), place)
    lines = rows.groupBy(*where).agg(F.collect_list(place).alias("every"), F.collect_list(numbers).alias("numbers"), F.min(numbers).alias("first"), F.max(F.when(F.col("digit"), F.col("x") + F.col("w"))).alias("right"))
    lines = lines.select(*where, text(F.col("every")).alias("text"), text(F.col("numbers")).alias("digits"), F.col("first.x").alias("left"), "right")
    shown = lines.where(~F.col("text").rlike(furniture))
    heading = F.when(F.length("digits").between(1, 2), F.lpad("digits", 2, "0"))
    so_far = Window.partitionBy(*by).orderBy("page", "line").rowsBetween(Window.unboundedPreceding, 0)
    found = shown.withColumn("province", F.last(heading, ignorenulls=True).over(so_far)).where(F.length("digits") == 4)
    require_none(found.where("province IS NULL OR NOT startswith(digits, province)").select("page", "digits", "province"), "a code under the heading of another province")
    require_unique(found, [*by, "digits"], "a code is printed twice")
    names = rows.where(~F.col("digit")).join(found.select(*where, "left", "right"), where)
    fr = _word(names.where("x < left"), where, False, "fr", gap)
    ar = _word(names.where("x >= right"), where, True, "ar", gap)
    joined = found.join(fr, where, "left").join(ar, where, "left")
    return joined.select(*where, "province", F.col("digits").alias("code"), F.coalesce("fr", F.lit("")).alias("fr"), F.coalesce("ar", F.lit("")).alias("ar"))


def _closes(word: Column, following: Column) -> Column:
    """Whether a list ends with this word: it has a full stop at its end, or a guillemet or an article behind one. The stop
    of a number ends nothing, unless a guillemet, an article or nothing follows."""
    number = word.rlike("[0-9][.]$")
    outside = following.isNull() | following.rlike("^(?:[«»]|Art\\b)")
    return word.rlike("[.](?:[«»]|Art\\b)") | (word.endswith(".") & (~number | outside))


def numbered_items(frame: DataFrame, body: Column) -> DataFrame:
    """``frame`` with a row for each item of ``body`` ("1. A ; 2 B ; 3. C."): number and name; other parts are left out.

    The words of the list are looked at one by one up to the one that closes it; what follows is left out. Semicolons part the
    items. An item is a number of one or two digits, with or without a full stop, and a name. A null body has none.
    """
    words = F.filter(F.split(F.replace(body, F.lit(";"), F.lit(" ; ")), r"\s+"), lambda w: w != "")
    rows = frame.withColumn("_words", words)
    rows = rows.withColumn("_ends", F.transform("_words", lambda w, i: _closes(w, F.get("_words", i + 1))))
    rows = rows.withColumn("_end", F.array_position("_ends", True).cast("int"))
    last = F.regexp_replace(F.get("_words", F.col("_end") - 1), "[.](?:(?:[«»]|Art\\b).*)?$", "")
    listed = F.when(F.col("_end") > 0, F.concat(F.slice("_words", 1, F.greatest(F.col("_end") - 1, F.lit(0))), F.array(last))).otherwise(F.col("_words"))
    parts = F.transform(F.split(F.array_join(listed, " "), ";"), lambda x: F.trim(x))
    rows = rows.withColumn("_item", F.explode(parts)).drop("_words", "_ends", "_end")
    first, name = F.substring_index("_item", " ", 1), F.regexp_replace("_item", "^[^ ]+ ?", "")
    digits = F.rtrim(first, F.lit("."))
    rows = rows.withColumn("number", F.when(digits.rlike("^[0-9]{1,2}$") & (F.length(first) - F.length(digits) <= 1), digits).cast("int")).withColumn("name", F.regexp_replace(name, "^[.] ", ""))
    return rows.where("number IS NOT NULL AND name <> ''").drop("_item")


def incomplete(items: DataFrame, lists: DataFrame, by: list[str]) -> DataFrame:
    """(by, announced, found) of lists whose items aren't numbered 1 to the count that their heading announces."""
    seen = items.groupBy(*by).agg(F.array_sort(F.collect_set("number")).alias("_n"), F.count(F.lit(1)).alias("found"))
    wanted = F.when(F.col("announced") > 0, F.sequence(F.lit(1), F.col("announced"))).otherwise(F.array().cast("array<int>"))
    joined = lists.join(seen, by, "left").withColumn("found", F.coalesce("found", F.lit(0)))
    return joined.where((F.coalesce("_n", F.array().cast("array<int>")) != wanted) | (F.col("found") != F.col("announced"))).select(*by, "announced", "found")


def reconciled(lists: DataFrame, read: DataFrame, exact: DataFrame, pairs: DataFrame, *, keep_spaces: bool = True) -> DataFrame:
    """(list, number, name, check): every announced item from two readings of a document.

    ``lists``: doc, list, announced. ``read``: doc, list, place, number, name; ``exact``: doc, place, number, name;
    ``pairs``: doc, l_order, r_order, their alignment by place. Where both have the letters the exact spelling holds
    (check empty, or ``spaces`` where the spaces differ and aren't trusted); else ``differs``, or ``ocr`` or ``pdf`` where one
    reading alone has the item, the exact one between its neighbours' partners, or ``missing``.
    """
    wanted = lists.withColumn("number", F.explode(F.when(F.col("announced") > 0, F.sequence(F.lit(1), F.col("announced")))))
    partner = exact.select("doc", F.col("place").alias("r_order"), F.col("name").alias("exact_name"))
    known = read.join(pairs, (read["doc"] == pairs["doc"]) & (read["place"] == pairs["l_order"]), "left").select(read["doc"], "list", "number", "place", read["name"].alias("read_name"), "r_order")
    rows = wanted.join(known.join(partner, ["doc", "r_order"], "left"), ["doc", "list", "number"], "left")
    order = Window.partitionBy("doc").orderBy("list", "number")
    rows = rows.withColumn("_low", F.max("r_order").over(order.rowsBetween(Window.unboundedPreceding, -1))).withColumn("_high", F.min("r_order").over(order.rowsBetween(1, Window.unboundedFollowing)))
    gaps = rows.where("place IS NULL").select("doc", "list", "number", F.coalesce("_low", F.lit(-1)).alias("_low"), F.coalesce("_high", F.lit(1 << 40)).alias("_high"))
    between = gaps.join(exact.select("doc", "number", F.col("place").alias("_p"), F.col("name").alias("_found")), ["doc", "number"]).where("_p > _low AND _p < _high")
    single = between.groupBy("doc", "list", "number").agg(F.min("_found").alias("_found"), F.count(F.lit(1)).alias("_n")).where("_n = 1")
    rows = rows.drop("_low", "_high").join(single, ["doc", "list", "number"], "left")
    same = squeezed(F.col("exact_name")) == squeezed(F.col("read_name"))
    spaces = F.lit(keep_spaces) | (F.col("exact_name") == F.col("read_name"))
    check = (
        F.when(F.col("exact_name").isNotNull(), F.when(~same, "differs").when(spaces, "").otherwise("spaces"))
        .when(F.col("read_name").isNotNull(), "ocr")
        .when(F.col("_found").isNotNull(), "pdf")
        .otherwise("missing")
    )
    return rows.select("doc", "list", "number", F.coalesce("exact_name", "read_name", "_found", F.lit("")).alias("name"), check.alias("check"))


def doubt(seat: Column, members: Column, latin: bool) -> Column:
    """Why a district's row (an array of seat lines, one of members) needs a look, or null."""
    joined = letters_only(F.array_join(seat, " "), latin)
    first = letters_only(F.get(members, F.lit(0)), latin)
    return F.when(F.size(seat) <= 0, "no seat").when(F.size(members) <= 0, "no members").when(joined != first, "the seat is not the first member")


def worst_check(checks: Column) -> Column:
    """Of a row's checks: 'ocr' before 'eye' before none."""
    return F.when(F.array_contains(checks, "ocr"), "ocr").when(F.array_contains(checks, "eye"), "eye").otherwise("")


def reading_id(text: Column, article: Column, item: Column, edition: Column) -> Column:
    """The identifier of a name that was read by eye."""
    return F.concat_ws("-", *(F.regexp_replace(c, r"[\s/]+", "-") for c in (text, article, item, edition)))


def standing_alifs(text: Column) -> Column:
    """The alifs that join nothing before them, in the order of the text."""
    return F.regexp_extract_all(text, F.lit("(?:^|(?<=[ اأإآدذرزوؤىةء]))([اأإآ])"), F.lit(1))


def neighbourhoods(rows: DataFrame, by: list[str], order: str, value: str) -> DataFrame:
    """``rows`` with before and after: the values of the rows next to it."""
    w = Window.partitionBy(*by).orderBy(order)
    return rows.withColumn("before", F.lag(value).over(w)).withColumn("after", F.lead(value).over(w))


#: Kinds of changes that ask for a release (fixed values of the convention for titles).
RELEASED = ("feat", "fix", "perf", "revert")


def releases(title: Column) -> Column:
    """Whether a change of this title ("kind(scope)!: what it does") asks for a release: a kind that does, or a mark of
    a breaking change. Titles of another form don't."""
    head = F.substring_index(F.trim(title), ": ", 1)
    named = F.trim(title).startswith(F.concat(head, F.lit(": "))) & (F.length(F.trim(title)) > F.length(head) + 2)
    breaking = head.endswith("!")
    plain = F.regexp_replace(head, "!$", "")
    kind = F.regexp_replace(plain, r"\([A-Za-z0-9_./-]+\)$", "")
    return named & kind.rlike("^[A-Za-z0-9_]+$") & (breaking | kind.isin(*RELEASED))
