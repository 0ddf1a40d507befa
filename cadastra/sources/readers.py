"""Readers: everything is text until it is published; order is carried in a column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def csv_table(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV file with a header; all columns are strings, quoted commas stay, empty fields are null."""
    schema = StructType([StructField(c, StringType()) for c in columns])
    return spark.read.schema(schema).options(header=True, escape='"', encoding="UTF-8", enforceSchema=False).csv(path)


def source_text(spark: SparkSession, folder: str, text: str, columns: list[str]) -> DataFrame:
    """One transcription, a file of its own."""
    return csv_table(spark, f"{folder}/{text}.csv", columns)


def grouped_lists(rows: DataFrame, key: str, order: str) -> DataFrame:
    """key and ``rows``: its rows in the order of their own numbers."""
    item = F.struct(F.col(order).cast("int").alias("_o"), *(F.col(c) for c in rows.columns if c != key))
    return rows.groupBy(key).agg(F.array_sort(F.collect_list(item)).alias("rows"))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON object a line, with a given schema; geometry is double, alternatives are arrays."""
    return spark.read.schema(schema).json(path)


def grouped_json(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """key and ``rows``: the records of a file of JSON lines, those of each key in the order of the file."""
    names = [f.name for f in spark.read.schema(schema).json(path).schema.fields]
    whole = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("_o", "line")).where("trim(line) <> ''")
    rows = whole.select("_o", F.from_json("line", schema).alias("r")).select("_o", "r.*")
    return rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_o", *(n for n in names if n != key)))).alias("rows"))


def rules_by_column(spark: SparkSession, path: str) -> DataFrame:
    """(page, side, ys): the heights of the rules of each column of a page, from the top."""
    rows = json_lines(spark, path, "page int, side string, y double").where("y IS NOT NULL")
    return rows.groupBy("page", "side").agg(F.array_sort(F.collect_list("y")).alias("ys"))


def new_and_old(rows: DataFrame, article: str, prefix: str = "52 bis") -> tuple[DataFrame, DataFrame]:
    """Lists of articles that a text has added, whose numbers begin with ``prefix``, and the others; a null article is old."""
    added = F.coalesce(F.col(article).startswith(prefix), F.lit(False))
    return rows.where(added), rows.where(~added)


def readings(spark: SparkSession, path: str, columns: list[str], text: str) -> DataFrame:
    """The names read by eye of one text; a missing file is an empty table."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], StructType([StructField(c, StringType()) for c in columns]))
    return csv_table(spark, path, columns).where(F.col("text") == text)


def known_labels(spark: SparkSession, path: str) -> DataFrame:
    """(kind, lang, label), distinct, of a query result with bindings."""
    value = lambda n: f"struct<value:string>"
    schema = f"results struct<bindings:array<struct<kind:{value(0)},lang:{value(0)},label:{value(0)}>>>"
    rows = spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("results.bindings").alias("b"))
    return rows.select(F.col("b.kind.value").alias("kind"), F.col("b.lang.value").alias("lang"), F.col("b.label.value").alias("label")).where("label IS NOT NULL").distinct()


def marked_lines(spark: SparkSession, path: str, marker: str) -> DataFrame:
    """(file, line, page, text): lines of text files with the page that the last ``marker`` line before them names.

    ``marker`` is a regular expression with the page as its first group. A file is one task's work, as its lines have
    an order that nothing in them says.
    """
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    lines = whole.select("file", F.posexplode(F.split("value", "\r?\n")).alias("line", "text"))
    page = F.nullif(F.regexp_extract("text", marker, 1), F.lit(""))
    w = Window.partitionBy("file").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    rows = lines.withColumn("_mark", page).withColumn("page", F.last("_mark", ignorenulls=True).over(w).cast("int"))
    return rows.where("_mark IS NULL AND text <> ''").select("file", "line", "page", "text")


def reading_order(lines: DataFrame, *, head: float, rtl: bool = False, middle: float = 0.5) -> DataFrame:
    """Lines below the running head, with ``place``: page, column (the right one first if ``rtl``), height, text."""
    column = F.when((F.col("x") + F.col("w") / 2 < middle) != F.lit(rtl), 0).otherwise(1)
    order = Window.partitionBy("page").orderBy("column", "y", "text")
    return lines.where(F.col("y") >= head).withColumn("column", column).withColumn("place", F.row_number().over(order))


def changelog(text: DataFrame, column: str = "value") -> DataFrame:
    """(version, date, entry, place) of a changelog, newest first: headings ``## [1.2.3](link) (2026-01-31)`` or
    ``## 1.2.3 - 2026-01-31``."""
    heading = r"(?m)^## \[?(\d+\.\d+\.\d+)\]?(?:\([^)]*\))? (?:\(|[-–—] )(\d{4}-\d{2}-\d{2})\)?[ \t]*$"
    rows = text.select(
        F.arrays_zip(
            F.regexp_extract_all(column, F.lit(heading), F.lit(1)).alias("version"),
            F.regexp_extract_all(column, F.lit(heading), F.lit(2)).alias("date"),
            F.slice(F.split(column, heading), 2, 1 << 20).alias("entry"),
        ).alias("e")
    ).select(F.posexplode("e").alias("place", "e"))
    return rows.select("e.version", "e.date", F.trim(F.regexp_replace("e.entry", r"^\s+|\s+$", "")).alias("entry"), "place")


def newest_entry(entries: DataFrame) -> DataFrame:
    """The first entry of a changelog, one row or none."""
    return entries.orderBy("place").limit(1)


def version_key(version) -> F.Column:
    """Versions as three numbers, which order as such."""
    part = lambda k: F.split(version, r"\.")[k].cast("int")
    return F.struct(part(0).alias("major"), part(1).alias("minor"), part(2).alias("patch"))


def publication_dates(texts: DataFrame, lists: DataFrame) -> DataFrame:
    """(text, date) of texts and lists; dates are strings, as some name a month or a year only."""
    return texts.select(F.col("id").alias("text"), F.col("jo_date").alias("date")).unionByName(lists.select(F.col("id").alias("text"), F.col("published").alias("date")))
