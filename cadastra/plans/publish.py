"""The published form of the tables: every answer is a document with a path.

Tables are flat and textual: provinces, districts, municipalities, changes, aliases, texts. Each record is turned once into
the pieces that documents hold of it, its own document, its parents' lists, whole tables, CSV lines, and one shuffle
by path puts all documents together. A document of one record, one parent's list or a whole table is one row of
``documents``; a whole table's is as large as the table, which has to fit a row (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.functions.text import slug
from cadastra.operators.nest import cite, csv_line, json_object

#: Provinces up to this number have a code of the international list; the later ones are still administered by others.
ISO_PROVINCES = 58


def _name(fr: str = "name_fr", ar: str = "name_ar") -> Column:
    return json_object({"ar": F.col(ar), "fr": F.col(fr)})


def _array(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def _or_null(condition: Column, value: Column) -> Column:
    return F.when(condition, value)


def _given(column: str) -> Column:
    return F.nullif(F.col(column), F.lit(""))


def with_aliases(frame: DataFrame, kind: str, aliases: DataFrame) -> DataFrame:
    """``frame`` with ``aliases``: a JSON array of other names in the order of language and name, empty by default."""
    texts = _array(F.transform(F.filter(F.split(F.coalesce("texts", F.lit("")), " "), lambda t: t != ""), lambda t: F.concat(F.lit('"'), t, F.lit('"'))))
    rows = aliases.where(F.col("kind") == kind).select("code", "lang", "name", json_object({"lang": F.col("lang"), "name": F.col("name")}, {"texts": texts}).alias("a"))
    listed = rows.groupBy("code").agg(_array(F.transform(F.array_sort(F.collect_list(F.struct("lang", "name", "a"))), lambda x: x["a"])).alias("aliases"))
    return frame.join(listed, "code", "left").withColumn("aliases", F.coalesce("aliases", F.lit("[]")))


def municipality_records(municipalities: DataFrame, changes: DataFrame, aliases: DataFrame) -> DataFrame:
    """``municipalities`` with record and summary (JSON); a move's last entry says when it was."""
    moves = changes.where("type = 'member_moved'").groupBy(F.col("subject").alias("code")).agg(F.max_by(F.struct("date", "by", "article", "item"), "date").alias("move"))
    rows = with_aliases(municipalities, "municipality", aliases).join(moves, "code", "left")
    by = cite(F.col("move.by"), F.col("move.article"), F.col("move.item"))
    before = _or_null(_given("province_before").isNotNull(), json_object({"province": F.col("province_before"), "until": F.col("move.date")}, {"by": F.when(F.col("move").isNotNull(), by)}))
    listed = cite(F.col("listed_by"), F.col("listed_article"), F.col("listed_item"))
    record = json_object(
        {"code": F.col("code")},
        {
            "name": _name(), "slug": _quoted(slug(F.col("name_fr"))),
            "province": _quoted(F.col("province")), "district": _quoted(_given("district")), "province_before": before, "listed_by": listed,
            "names_from": json_object({"ar": F.col("name_ar_by"), "fr": F.col("name_fr_by")}), "previous_codes": F.lit("[]"), "aliases": F.col("aliases"),
        },
    )
    summary = json_object({"code": F.col("code")}, {"name": _name(), "slug": _quoted(slug(F.col("name_fr"))), "district": _quoted(_given("district"))})
    return rows.select(*municipalities.columns, record.alias("record"), summary.alias("summary"))


def _quoted(value: Column) -> Column:
    """A string as JSON; null is null."""
    wrapped = F.to_json(F.struct(value.alias("s")))
    return F.when(value.isNotNull(), wrapped.substr(F.lit(6), F.length(wrapped) - 6))


def district_records(districts: DataFrame, aliases: DataFrame) -> DataFrame:
    rows = with_aliases(districts, "district", aliases)
    raw = {"name": _name(), "slug": _quoted(slug(F.col("name_fr")))}
    counts = json_object({"municipalities": F.col("municipalities").cast("int")})
    listed = cite(F.col("listed_by"), F.col("listed_article"), F.col("listed_item"))
    record = json_object({"code": F.col("code")}, {**raw, "province": _quoted(F.col("province")), "listed_by": listed, "counts": counts, "aliases": F.col("aliases")})
    return rows.select(*districts.columns, record.alias("record"), json_object({"code": F.col("code")}, {**raw, "municipalities": F.col("municipalities").cast("int").cast("string")}).alias("summary"))


def province_records(provinces: DataFrame, aliases: DataFrame, *, base_text: str, country: str, transition: dict[str, str]) -> DataFrame:
    """Provinces, enriched: international code, what defines and amends them, creation, administration in transition."""
    rows, n = with_aliases(provinces, "province", aliases), F.col("code").cast("int")
    defined = json_object({"text": F.lit(base_text), "article": F.col("listed_article"), "amended_by": F.when(F.col("listed_by") != base_text, F.col("listed_by"))})
    created = _or_null(_given("created").isNotNull(), json_object({"date": F.col("created")}, {"by": cite(F.col("created_by"), F.col("created_article"))}))
    administered = _or_null(n > ISO_PROVINCES, json_object({"province": _given("parent"), "until": F.lit(transition["until"])}, {"by": cite(F.lit(transition["text"]), F.lit(transition["article"]))}))
    record = json_object(
        {"code": F.col("code"), "iso_3166_2": F.when(n <= ISO_PROVINCES, F.concat(F.lit(f"{country}-"), "code"))},
        {
            "name": _name(), "slug": _quoted(slug(F.col("name_fr"))), "seat": _quoted(_given("seat")), "named_by": cite(F.col("named_by"), F.col("named_article"), F.col("named_item")), "defined_by": defined,
            "created": created, "parent": _quoted(_given("parent")), "administered_by": administered,
            "counts": json_object({"districts": F.col("districts").cast("int"), "municipalities": F.col("municipalities").cast("int")}), "aliases": F.col("aliases"),
        },
    )
    return rows.select(*provinces.columns, record.alias("record"))


def file_key(path: Column) -> Column:
    """The identifier of a path in the index."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(path, r"[{}]", ""), r"\.", "_"), "[/-]", "_")


#: What follows the version in a document of one kind: its key, then what its slots are put between.
_LISTS = {
    "municipality_list": "municipalities", "district_list": "districts", "provinces": "provinces", "districts": "districts", "municipalities": "municipalities", "changes": "changes", "texts": "texts",
    "division_municipalities": "municipalities", "division_provinces": "provinces",
}


def _piece(path: Column, kind: str, slot: int, order: Column, text: Column, then: Column | None = None) -> Column:
    """What a document holds of a record: ``slot`` 1 to 3 are its places, in each of them pieces go by ``order``, then ``then``. Slot 0
    says that there is a document, whether or not a piece is in it."""
    return F.struct(path.alias("path"), F.lit(kind).alias("kind"), F.lit(slot).alias("slot"), order.alias("a"), F.coalesce(then, F.lit("")).alias("b") if then is not None else F.lit("").alias("b"), text.alias("text"))


def _spread(frame: DataFrame, pieces: list[Column]) -> DataFrame:
    return frame.select(F.explode(F.array(*pieces)).alias("p")).where(F.col("p.path").isNotNull()).select("p.*")


def _flattened(country: str, transition: dict[str, str]) -> dict[str, dict[str, Column]]:
    """Of each table the columns of its CSV files: what its records nest, side by side, empty where a record has null."""
    plain = lambda *names: {n: F.col(n) for n in names}
    names, listed = plain("name_fr", "name_ar") | {"slug": slug(F.col("name_fr"))}, plain("listed_by", "listed_article", "listed_item")
    n = F.col("code").cast("int")
    iso, later = F.when(n <= ISO_PROVINCES, F.concat(F.lit(f"{country}-"), "code")), n > ISO_PROVINCES
    administered = {"administered_by": F.when(later, F.col("parent")), "administered_until": F.when(later, F.lit(transition["until"]))}
    return {
        "provinces": plain("code") | {"iso_3166_2": iso} | names | plain("seat", "parent", "created") | administered | plain("districts", "municipalities"),
        "districts": plain("code", "province") | names | plain("municipalities") | listed,
        "municipalities": plain("code", "province", "district") | names | plain("province_before") | listed,
        "changes": plain("date", "type", "subject", "from", "to", "by", "article", "item"),
    }


def _open(record: Column) -> Column:
    """A JSON object without its last brace."""
    return record.substr(F.lit(1), F.length(record) - 1)


def documents(tables: dict[str, DataFrame], *, version: str, base_text: str, country: str, transition: dict[str, str], division: str) -> DataFrame:
    """(path, kind, body) of all documents. ``division`` names the year before the last changes.

    Each table is spread into pieces of documents, pieces are shuffled once, by path. Lists of a province and a province's or
    district's own document are there if its row is, with empty lists where nothing belongs to it; documents of
    whole tables are there in any case. Records of a parent without a row are in the whole tables alone.
    """
    t = tables
    path = lambda *parts: F.concat(*(p if isinstance(p, Column) else F.lit(p) for p in parts))
    code, none = F.col("code"), F.lit(None).cast("string")
    flat = _flattened(country, transition)
    line = lambda name: csv_line(list(flat[name].values()))
    province, district = F.col("province"), _given("district")

    municipalities = municipality_records(t["municipalities"], t["changes"], t["aliases"])
    before = F.coalesce(_given("province_before"), province)
    early = json_object({"code": code}, {"name": _name(), "slug": _quoted(slug(F.col("name_fr"))), "province": _quoted(before)})
    record, summary = F.col("record"), F.col("summary")
    pieces = _spread(municipalities, [
        _piece(path("municipalities/", code, ".json"), "municipality", 1, code, record),
        _piece(path("municipalities.json"), "municipalities", 1, code, record),
        _piece(path("provinces/", province, "/municipalities.json"), "municipality_list", 1, code, summary),
        _piece(path("provinces/", province, ".json"), "province", 3, code, summary),
        _piece(path("districts/", district, ".json"), "district", 2, code, summary),
        _piece(path(f"divisions/{division}/municipalities.json"), "division_municipalities", 1, code, early),
        _piece(path("municipalities.csv"), "csv", 1, code, line("municipalities")),
        _piece(path("provinces/", province, "/municipalities.csv"), "csv", 1, code, line("municipalities")),
        _piece(path("index.json"), "index", 3, code, none),
    ])
    pieces = pieces.unionByName(_spread(district_records(t["districts"], t["aliases"]), [
        _piece(path("districts/", code, ".json"), "district", 1, code, _open(record)),
        _piece(path("districts.json"), "districts", 1, code, record),
        _piece(path("provinces/", province, "/districts.json"), "district_list", 1, code, summary),
        _piece(path("provinces/", province, ".json"), "province", 2, code, summary),
        _piece(path("districts.csv"), "csv", 1, code, line("districts")),
        _piece(path("index.json"), "index", 2, code, none),
    ]))
    # provinces of the time before the last changes, with what they had then
    counts = t["municipalities"].groupBy(before.alias("_then")).agg(F.count(F.lit(1)).alias("_n"))
    rows = province_records(t["provinces"], t["aliases"], base_text=base_text, country=country, transition=transition).join(counts, code == F.col("_then"), "left")
    shown = json_object({"code": code}, {"name": _name(), "slug": _quoted(slug(F.col("name_fr"))), "municipalities": F.coalesce("_n", F.lit(0)).cast("string")})
    old = F.when(code.cast("int") <= ISO_PROVINCES, F.lit(f"divisions/{division}/provinces.json"))
    pieces = pieces.unionByName(_spread(rows, [
        _piece(path("provinces/", code, ".json"), "province", 1, code, _open(record)),
        _piece(path("provinces.json"), "provinces", 1, code, record),
        _piece(path("provinces/", code, "/municipalities.json"), "municipality_list", 0, code, none),
        _piece(path("provinces/", code, "/districts.json"), "district_list", 0, code, none),
        _piece(old, "division_provinces", 1, code, shown),
        _piece(path("provinces.csv"), "csv", 1, code, line("provinces")),
        _piece(path("index.json"), "index", 1, code, none),
    ]))
    change = json_object({c: F.col(c) for c in ("date", "type", "subject", "from", "to")}, {"by": cite(F.col("by"), F.col("article"), F.col("item"))})
    rank = F.concat(F.when(F.col("type") == "province_created", "0").otherwise("1"), "subject")
    pieces = pieces.unionByName(_spread(t["changes"], [
        _piece(path("changes.json"), "changes", 1, rank, change, F.col("date")),
        _piece(path("changes.csv"), "csv", 1, F.col("subject"), line("changes")),
        _piece(path("index.json"), "index", 4, F.col("subject"), none),
    ]))
    text = json_object({c: F.col(c).cast("int") if c == "jo_number" else F.col(c) for c in t["texts"].columns})
    pieces = pieces.unionByName(_spread(t["texts"], [_piece(path("texts.json"), "texts", 1, F.col("id"), text)]))
    always = [(f"{n}.json", n) for n in ("provinces", "districts", "municipalities", "changes", "texts")] + [(f"{n}.csv", "csv") for n in ("provinces", "districts", "municipalities", "changes")]
    always += [(f"divisions/{division}/municipalities.json", "division_municipalities"), (f"divisions/{division}/provinces.json", "division_provinces"), ("index.json", "index")]
    anchors = [F.struct(F.lit(p).alias("path"), F.lit(k).alias("kind"), F.lit(0).alias("slot"), F.lit("").alias("a"), F.lit("").alias("b"), none.alias("text")) for p, k in always]
    pieces = pieces.unionByName(_spread(t["texts"].sparkSession.range(1, numPartitions=1), anchors))

    slot = F.col("slot")
    item = F.when(F.col("text").isNotNull(), F.struct("slot", "a", "b", "text"))
    found = pieces.groupBy("path", "kind").agg(
        F.array_sort(F.collect_list(item)).alias("items"), F.min("slot").alias("first"), *(F.count(F.when(slot == k, 1)).alias(f"n{k}") for k in (1, 2, 3, 4))
    )
    # what parents' documents hold of records whose parent has no row is no document
    found = found.where(~(F.col("kind").isin("province", "district") & (F.col("first") > 1)) & ~(F.col("kind").isin("municipality_list", "district_list") & (F.col("first") > 0)))
    joined = lambda k, glue=",": F.array_join(F.transform(F.filter("items", lambda i: i["slot"] == k), lambda i: i["text"]), glue)
    listed = lambda k: F.concat(F.lit("["), joined(k), F.lit("]"))
    kind = F.col("kind")
    inner = F.when(kind == "municipality", F.concat(F.lit('"municipality":'), joined(1)))
    inner = inner.when(kind == "district", F.concat(F.lit('"district":'), joined(1), F.lit(',"municipalities":'), listed(2), F.lit("}")))
    inner = inner.when(kind == "province", F.concat(F.lit('"province":'), joined(1), F.lit(',"districts":'), listed(2), F.lit(',"municipalities":'), listed(3), F.lit("}")))
    for name, key in _LISTS.items():
        inner = inner.when(kind == name, F.concat(F.lit(f'"{key}":'), listed(1)))
    files = ["provinces.json", "districts.json", "municipalities.json", "changes.json", "texts.json", "provinces/{code}.json", "districts/{code}.json", "municipalities/{code}.json"]
    index = F.to_json(F.map_from_arrays(F.array(*(file_key(F.lit(p)) for p in files)), F.array(*map(F.lit, files))))
    totals = json_object({n: F.col(f"n{k}") for k, n in enumerate(("provinces", "districts", "municipalities", "changes"), 1)})
    inner = inner.when(kind == "index", F.concat(F.lit('"counts":'), totals, F.lit(',"files":'), index))
    head = None
    for name in ("provinces", "districts", "municipalities", "changes"):
        names = F.lit(",".join(flat[name]) + "\n")
        here = F.element_at(F.split("path", "/"), -1) == f"{name}.csv"
        head = F.when(here, names) if head is None else head.when(here, names)
    csv = F.concat(head, F.array_join(F.transform("items", lambda i: F.concat(i["text"], F.lit("\n"))), ""))
    body = F.when(kind == "csv", csv).otherwise(F.concat(F.lit('{"data_version":'), _quoted(F.lit(version)), F.lit(","), inner, F.lit("}\n")))
    return found.select("path", "kind", body.alias("body"))
