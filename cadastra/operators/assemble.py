"""The five result tables (provinces, districts, municipalities, changes, aliases), assembled from the state that the
source texts have built. Columns are those that publishing reads, see ``plans/publish.py``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.functions.text import arabic_key, latin_key
from cadastra.operators.checks import require_none, require_unique
from cadastra.operators.events import State, aliases, latest_names
from cadastra.operators.joins import either_key, exactly_one, last_wins, match_counts, respelled
from cadastra.operators.storage import kept

_KEYS = [("fr_key", "fr_key"), ("ar_key", "ar_key")]


def _keyed(frame: DataFrame, scope: str, fr: str = "fr", ar: str = "ar") -> DataFrame:
    inside = lambda key: F.when(key.isNotNull(), F.concat_ws("|", F.col(scope), key))
    return frame.withColumn("fr_key", inside(latin_key(F.col(fr)))).withColumn("ar_key", inside(arabic_key(F.col(ar))))


def coded(state: State, codes: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """(uid, code): members paired with the codes (province, code, fr, ar) of their province, one to one.

    ``extra`` (code, fr) has second names of codes; each must be needed, or it is an error.
    """
    printed = _keyed(state.printed.join(state.members.select("uid", "province"), "uid"), "province").select("uid", "fr_key", "ar_key")
    wanted = _keyed(codes, "province").select("code", "fr_key", "ar_key")
    if extra is not None:
        again = codes.select("code", "province").join(extra, "code").withColumn("ar", F.lit(None).cast("string"))
        second = _keyed(again, "province").select("code", "fr_key", "ar_key")
        unused = second.select("code").join(either_key(second, printed, "code", "uid", _KEYS), "code", "left_anti")
        require_none(unused, "second names that no member needs")
        wanted = wanted.unionByName(second)
    pairs = either_key(printed.withColumnRenamed("uid", "m"), wanted, "m", "code", _KEYS).withColumnRenamed("m", "uid")
    require_none(state.members.select("uid").join(pairs, "uid", "left_anti"), "members without a code")
    require_unique(pairs, ["uid"], "members with several codes")
    require_unique(pairs, ["code"], "codes with several members")
    require_none(codes.select("code").join(pairs, "code", "left_anti"), "codes without a member")
    return pairs


def seats(state: State, codes: DataFrame) -> DataFrame:
    """(district, code): the member that a district's seat names; districts whose seat is none of theirs have no row. Computed once."""
    within = state.printed.join(state.members.select("uid", "district"), "uid").where("district IS NOT NULL")
    printed = _keyed(within, "district").select("uid", "fr_key", "ar_key")
    named = _keyed(state.districts.where("seat_fr IS NOT NULL OR seat_ar IS NOT NULL"), "district", "seat_fr", "seat_ar").select("district", "fr_key", "ar_key")
    counted = kept(match_counts(named, printed, "district", "uid", _KEYS))
    require_none(counted.where("matches > 1"), "a seat names several members")
    return kept(counted.where("matches = 1").select("district", F.col("match").alias("uid")).join(codes, "uid").select("district", "code"))


def _in_both(names: DataFrame) -> None:
    require_none(names.where("coalesce(fr, '') = '' OR coalesce(ar, '') = ''"), "a name is printed in one language only")


def resolved_names(state: State, codes: DataFrame, listed: DataFrame, renamed: list[str] = (), arabic_listed: list[str] = (), until: list[str] | None = None) -> DataFrame:
    """(code, fr, fr_by, ar, ar_by): the latest text's names; of ``renamed`` codes both from the list (code, fr, ar, by),
    of ``arabic_listed`` the Arabic one. Such an exception must still be needed: the latest text is one of ``until``."""
    out = _cited_names(state, codes, listed, renamed, arabic_listed, until).drop("cite")
    _in_both(out)
    return out


def _cited_names(state: State, codes: DataFrame, listed: DataFrame, renamed: list[str], arabic_listed: list[str], until: list[str] | None = None) -> DataFrame:
    """Names as above with the latest text's cite, and not yet held to be in both languages."""
    latest = latest_names(state.printed).join(codes, "uid").join(listed.select("code", F.col("fr").alias("l_fr"), F.col("ar").alias("l_ar"), F.col("by").alias("l_by")), "code", "left")
    both, arabic = F.col("code").isin(list(renamed)), F.col("code").isin([*renamed, *arabic_listed])
    if until is not None:
        require_none(latest.where(arabic & ~F.col("text").isin(until)).select("code", "text"), "a later text prints what an exception replaces")
    return latest.select(
        "code", "cite",
        F.when(both, F.col("l_fr")).otherwise(F.col("fr")).alias("fr"), F.when(both, F.col("l_by")).otherwise(F.col("text")).alias("fr_by"),
        F.when(arabic, F.col("l_ar")).otherwise(F.col("ar")).alias("ar"), F.when(arabic, F.col("l_by")).otherwise(F.col("text")).alias("ar_by"),
    )


def law_names(state: State, lists: DataFrame) -> DataFrame:
    """(uid, text, fr, ar): how law lists (text, province, fr, ar) print members, at most one row of each list."""
    rows = _keyed(lists.withColumn("row", F.xxhash64("text", "province", "fr", "ar")), "province")
    printed = _keyed(state.printed.join(state.members.select("uid", "province"), "uid"), "province").select("uid", "fr_key", "ar_key")
    pairs = either_key(rows.select("row", "fr_key", "ar_key"), printed, "row", "uid", _KEYS)
    pairs = kept(pairs.join(rows.select("row", "text", "fr", "ar"), "row"))
    require_unique(pairs, ["uid", "text"], "a list prints a member twice")
    return pairs.select("uid", "text", "fr", "ar")


def article_history(writings: DataFrame) -> DataFrame:
    """article with first and last of the texts that write it. ``writings``: article, seq, text, via."""
    return writings.groupBy("article").agg(F.min_by(F.struct("text", "via"), "seq").alias("first"), F.max_by("text", "seq").alias("last_text"))


def named_provinces(namings: DataFrame) -> DataFrame:
    """The last of a province's namings (province, seq, fr, ar, by, article, item)."""
    return last_wins(namings, ["province"], ["seq"])


def cited_moves(moved: DataFrame, law: DataFrame, names: DataFrame) -> DataFrame:
    """``moved`` (uid, from, to) with the article and item of the one row of ``law`` (province, article, item, fr, ar) that
    lists the member under any of its ``names`` (uid, fr, ar)."""
    known = _keyed(names.join(moved.select("uid", "to"), "uid"), "to").select("uid", "fr_key", "ar_key").distinct()
    rows = _keyed(law.withColumn("row", F.xxhash64("province", "article", "item")), "province")
    pairs = kept(either_key(known.withColumnRenamed("uid", "m"), rows.select("row", "fr_key", "ar_key"), "m", "row", _KEYS).withColumnRenamed("m", "uid"))
    require_unique(pairs, ["uid"], "several rows of the law list a member")
    require_none(moved.select("uid").join(pairs, "uid", "left_anti"), "no row of the law lists a member")
    return moved.join(pairs, "uid").join(rows.select("row", "article", "item"), "row").drop("row")


def municipalities(state: State, codes: DataFrame, names: DataFrame, before: DataFrame, seated: DataFrame | None = None) -> DataFrame:
    """The table of municipalities; ``before`` (code, province) is an earlier snapshot. ``names`` may have the latest text's cite, and
    ``seated`` is what ``seats`` gives, where they are known."""
    found = seats(state, codes) if seated is None else seated
    held = state.members.join(codes, "uid").join(found.select("district", F.col("code").alias("seat")), "district", "left")
    rows = held.join(names, "code")
    if "cite" not in names.columns:
        rows = rows.join(latest_names(state.printed).select("uid", "cite"), "uid")
    rows = rows.withColumn("c", F.split("cite", "/")).join(before.select("code", F.col("province").alias("earlier")), "code", "left")
    item = F.array_join(F.slice("c", 3, 9), "/")
    return rows.select(
        "code", "province", F.col("seat").alias("district"), F.col("fr").alias("name_fr"), F.col("ar").alias("name_ar"), F.col("fr_by").alias("name_fr_by"), F.col("ar_by").alias("name_ar_by"),
        F.col("c")[0].alias("listed_by"), F.col("c")[1].alias("listed_article"), item.alias("listed_item"), F.nullif("earlier", "province").alias("province_before"),
    )


def districts(state: State, codes: DataFrame, names: DataFrame, seated: DataFrame | None = None) -> DataFrame:
    """The table of districts: one for each whose seat is one of its members, under the seat's code and names."""
    found = seats(state, codes) if seated is None else seated
    require_unique(found, ["code"], "two districts share a seat")
    sizes = state.members.groupBy("district").agg(F.count(F.lit(1)).alias("municipalities"))
    rows = found.join(state.districts, "district").join(sizes, "district").join(names, "code").withColumn("c", F.split("cite", "/"))
    return rows.select("code", "province", F.col("fr").alias("name_fr"), F.col("ar").alias("name_ar"), F.col("c")[0].alias("listed_by"), F.col("c")[1].alias("listed_article"), F.col("c")[2].alias("listed_item"), "municipalities")


def provinces(
    state: State, codes: DataFrame, namings: DataFrame, parents: DataFrame, articles: DataFrame, writings: DataFrame, dates: DataFrame, districts_: DataFrame, base_law: str,
    *, without_seat: list[str] = (), spellings: dict[str, str] | None = None,
) -> DataFrame:
    """The table of provinces, one row for each that has members.

    The last of its ``namings`` (province, seq, fr, ar, seat_fr, seat_ar, by, article, item) names it; its seat is the one member
    printed under the seat's names, after ``spellings``, but for provinces ``without_seat``. Of the ``writings`` (article, seq, text,
    via) of its article (``articles``: province, article) the last lists it, ``base_law`` where there is none. A province with one of
    ``parents`` (province, parent) was created by the first, on that text's date (``dates``: text, date). A province
    without a naming, and a seat that fits no member or several, are errors.
    """
    held = state.members.groupBy("province").agg(F.count(F.lit(1)).alias("municipalities"))
    named = kept(held.join(named_provinces(namings), "province", "left"))
    require_none(named.where("by IS NULL").select("province"), "a province that no text names")
    wanted = named.where(~F.col("province").isin(list(without_seat))).select("province", respelled(F.col("seat_fr"), spellings or {}).alias("fr"), F.col("seat_ar").alias("ar"))
    printed = _keyed(state.printed.join(state.members.select("uid", "province"), "uid"), "province").select("uid", "fr_key", "ar_key")
    seat = exactly_one(_keyed(wanted, "province").select("province", "fr_key", "ar_key"), printed, "province", "uid", _KEYS, "the seat of a province")
    seat = seat.join(codes, "uid").select("province", F.col("code").alias("seat"))
    sizes = districts_.groupBy("province").agg(F.count(F.lit(1)).alias("districts"))
    history = article_history(writings)
    rows = named.join(seat, "province", "left").join(parents, "province", "left").join(articles.withColumnRenamed("article", "written"), "province", "left")
    rows = rows.join(history.withColumnRenamed("article", "written"), "written", "left").join(sizes, "province", "left")
    first, via = F.coalesce(F.col("first.text"), F.lit(base_law)), F.coalesce(F.col("first.via"), F.lit(""))
    rows = rows.withColumn("created_by", F.when(F.col("parent").isNotNull(), first)).withColumn("created_article", F.when(F.col("parent").isNotNull(), via))
    rows = rows.join(dates.select(F.col("text").alias("created_by"), F.col("date").alias("created")), "created_by", "left")
    return rows.select(
        F.col("province").alias("code"), F.col("fr").alias("name_fr"), F.col("ar").alias("name_ar"), F.col("by").alias("named_by"), F.col("article").alias("named_article"), F.col("item").alias("named_item"),
        "seat", "parent", "created", "created_by", "created_article", F.coalesce("last_text", F.lit(base_law)).alias("listed_by"), F.col("written").alias("listed_article"),
        F.coalesce("districts", F.lit(0)).alias("districts"), "municipalities",
    )


def changes(provinces_: DataFrame, municipalities_: DataFrame, state: State, codes: DataFrame, law: DataFrame, text: str, date: str) -> DataFrame:
    """The table of changes that the law ``text`` makes: the provinces it creates, then the municipalities that are elsewhere
    than before, each with the one row of ``law`` (province, article, item, fr, ar) that lists it under any of its names."""
    created = provinces_.where(F.col("created_by") == text).select(
        F.lit(date).alias("date"), F.lit("province_created").alias("type"), F.col("code").alias("subject"), F.col("parent").alias("from"), F.col("code").alias("to"),
        F.lit(text).alias("by"), F.col("created_article").alias("article"), F.lit(None).cast("string").alias("item"),
    )
    moved = municipalities_.where("province_before IS NOT NULL").join(codes, "code").select("uid", "code", F.col("province_before").alias("from"), F.col("province").alias("to"))
    cited = cited_moves(kept(moved), law, state.printed.select("uid", "fr", "ar"))
    rows = cited.select(F.lit(date).alias("date"), F.lit("member_moved").alias("type"), F.col("code").alias("subject"), "from", "to", F.lit(text).alias("by"), "article", "item")
    return created.unionByName(rows)


def all_aliases(state: State, codes: DataFrame, municipalities_: DataFrame, districts_: DataFrame, lists: DataFrame, dates: DataFrame, seated: DataFrame | None = None) -> DataFrame:
    """The table of aliases: every other spelling of a municipality's names in the texts and law ``lists`` (text, province, fr,
    ar), and of a district's in its seat's print, each with the texts that have it, oldest first (``dates``: text, date)."""
    printed = state.printed.join(codes, "uid").select("code", "seq", "text", "fr", "ar")
    lawful = law_names(state, lists).join(codes, "uid").select("code", F.lit(1 << 30).alias("seq"), "text", "fr", "ar")
    names = lambda table: table.select("code", F.col("name_fr").alias("fr"), F.col("name_ar").alias("ar"))
    found = aliases(printed.unionByName(lawful), names(municipalities_), dates, ["code"])
    found_seats = seats(state, codes) if seated is None else seated
    seated = found_seats.join(state.districts, "district").select("code", F.lit(0).alias("seq"), F.split("cite", "/")[0].alias("text"), F.col("seat_fr").alias("fr"), F.col("seat_ar").alias("ar"))
    own = aliases(seated, names(districts_), dates, ["code"])
    return found.select(F.lit("municipality").alias("kind"), "*").unionByName(own.select(F.lit("district").alias("kind"), "*"))


def tables(
    state: State, codes: DataFrame, before: DataFrame, listed: DataFrame, namings: DataFrame, parents: DataFrame, articles: DataFrame, writings: DataFrame, law: DataFrame, dates: DataFrame,
    *, base_law: str, law_text: str, renamed: list[str] = (), arabic_listed: list[str] = (), without_seat: list[str] = (), spellings: dict[str, str] | None = None,
) -> dict[str, DataFrame]:
    """The five tables of a state. ``codes``: uid, code, one to one, as rows meet by either; ``before``: code, province in the snapshot ahead of ``law_text``; ``law``: the
    rows of its lists (text, province, article, item, fr, ar), of which those of ``law_text`` are cited. The other parameters are those of
    the functions above. Each table is computed once, so that those built on it don't repeat it."""
    require_unique(codes, ["code"], "codes with several members")
    seated = seats(state, codes)
    members = kept(municipalities(state, codes, _cited_names(state, codes, listed, renamed, arabic_listed), before, seated))
    names = members.select("code", F.col("name_fr").alias("fr"), F.col("name_ar").alias("ar"))
    _in_both(names)
    places = kept(districts(state, codes, names, seated))
    units = kept(provinces(state, codes, namings, parents, articles, writings, dates, places, base_law, without_seat=without_seat, spellings=spellings))
    date = dates.where(F.col("text") == law_text).first()["date"]
    cited = law.where(F.col("text") == law_text).select("province", "article", "item", "fr", "ar")
    return {
        "provinces": units, "districts": places, "municipalities": members, "changes": changes(units, members, state, codes, cited, law_text, date),
        "aliases": all_aliases(state, codes, members, places, law.select("text", "province", "fr", "ar"), dates, seated),
    }
