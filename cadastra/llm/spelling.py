"""Spelling variants: words one edit apart, found by an even-partition pigeonhole join.

A word is cut into two segments, the first of half its length, rounded down. One edit leaves one of the segments as it was,
so of two words one edit apart the longer (or equal) one has a segment of the other: the first at its start, or the
second at its end, which is shifted by one where it is one longer. The index holds both segments of each word under their length and
number; a word probes with its substrings for its own length and for the length below. What meets is verified.

Short segments are shared by very many words. A segment that would bring more than ``MOST_PAIRS`` pairs together is cut
further by the same argument: the other segment, which holds the edit, is halved, and one of its halves is as it was.
So a frequent segment becomes many small groups, exactly, and no candidate is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.llm.common import checkpoint

#: A run of Latin letters.
RUN = "[A-Za-zÀ-ÿ]+"
#: One in so many occurrences loses a letter.
NOISE = 199
#: Pairs that a segment may bring together before it is cut further.
MOST_PAIRS = 4096
#: Rounds of root finding; each doubles the steps followed, and forms grow at least fivefold a step.
MOST_ROUNDS = 8

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def occurrences(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6) -> DataFrame:
    """(word): the words of all texts, a row for each occurrence, after the rule that deletes letters.

    ``NOISE`` divides the crc32 of ``<id>:<run>`` for the occurrences that lose the letter at crc32 % length. A null id
    is empty in that text; a null text has no words. Shorter results than ``least_length`` are left out.
    """
    text = F.translate(F.col(text_col).cast("string"), _UPPER, _LOWER)
    id_ = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    runs = docs.select(id_.alias("id"), F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run")).where(F.length("run") >= least_length)
    runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return runs.select(F.when(F.col("h") % NOISE == 0, cut).otherwise(F.col("run")).alias("word")).where(F.length("word") >= least_length)


def _part(word: Column, start, length) -> Column:
    """``length`` code points from ``start`` (from 0)."""
    return F.substring(word, start + F.lit(1), length)


def _keys(length: Column, longer: int) -> list[tuple[int, tuple[Column, Column], list[tuple[Column, Column]]]]:
    """For an indexed word of ``length``: (segment, its (start, size), the halves of the other), as places in a word that is
    ``longer`` (0 or 1) than it. What lies behind the edit is shifted by that."""
    first = F.floor(length / 2).cast("int")
    second = length - first
    f1, s1 = F.floor(first / 2).cast("int"), F.floor(second / 2).cast("int")
    zero = F.lit(0)
    return [
        (1, (zero, first), [(first, s1), (first + s1 + longer, second - s1)]),
        (2, (first + longer, second), [(zero, f1), (f1 + longer, first - f1)]),
    ]


def _signed(words: DataFrame, longer: int) -> DataFrame:
    """(word, length, segment, part, halves): what a word is indexed under, or probes with for words ``longer`` shorter."""
    word = F.col("word")
    length = F.length(word) - longer
    out = [
        F.struct(F.lit(k).alias("segment"), _part(word, *place).alias("part"), F.array(*(_part(word, *h) for h in halves)).alias("halves"))
        for k, place, halves in _keys(length, longer)
    ]
    rows = words.select("word", length.alias("length"), F.explode(F.array(*out)).alias("s"))
    return rows.select("word", "length", "s.segment", "s.part", "s.halves")


def near_pairs(words: DataFrame, *, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """(a, b) of all distinct words (column ``word``, each once) that are one inserted, deleted or replaced code point
    apart, each pair both ways. Words of a single code point have an empty first segment and are found as well."""
    key = ["length", "segment", "part"]
    index = _signed(words, 0)
    probe = _signed(words, 0).withColumn("equal", F.lit(True)).unionByName(_signed(words, 1).withColumn("equal", F.lit(False)))
    sizes = index.groupBy(*key).agg(F.count(F.lit(1)).alias("indexed")).join(probe.groupBy(*key).agg(F.count(F.lit(1)).alias("probing")), key)
    hot = checkpoint(sizes.where(F.col("indexed") * F.col("probing") > most_pairs).select(*key, F.lit(True).alias("hot")))

    def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        marked = rows.join(hot, key, "left")
        fine = marked.where("hot").select(*(c for c in rows.columns if c != "halves"), F.posexplode("halves").alias("half", "rest"))
        return marked.where("hot IS NULL").drop("hot", "halves"), fine

    (index_plain, index_fine), (probe_plain, probe_fine) = split(index), split(probe)

    def met(i: DataFrame, p: DataFrame, on: list[str]) -> DataFrame:
        pairs = i.withColumnRenamed("word", "a").join(p.withColumnRenamed("word", "b"), on)
        # of words of equal length, each is indexed and probes: one order is enough
        return pairs.where((~F.col("equal") | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1)).select("a", "b")

    found = met(index_plain, probe_plain, key).unionByName(met(index_fine, probe_fine, [*key, "half", "rest"])).distinct()
    return found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): the last word that forms lead to. A form's own count is larger, so no chain closes."""
    now = checkpoint(forms.select("word", F.col("form").alias("root")))
    for _ in range(MOST_ROUNDS):
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = checkpoint(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if not now.where("moved").take(1):
            return now.select("word", "root")
        now = now.drop("moved")
    raise RuntimeError(f"no end after {MOST_ROUNDS} rounds")


def variants(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6, least_count: int = 5, times: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n), a row for each distinct word of at least ``least_length`` code points and
    ``least_count`` occurrences in all texts.

    ``form`` is the near word (one edit away) of largest n, ties by code points, if that n is ``times`` the word's or more.
    ``root`` follows forms to the last. Occurrences are counted before they are shuffled, so a hot source or word is a
    row of each task. Null and empty texts have no words; repeated rows count each; an empty table gives no rows; extra
    columns are not looked at.
    """
    found = occurrences(docs, id_col=id_col, text_col=text_col, least_length=least_length)
    words = checkpoint(found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count))
    near = near_pairs(words.select("word")).join(words.select(F.col("word").alias("b"), "n"), "b")
    best = near.groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), "b")).alias("best"))
    rows = words.join(best.withColumnRenamed("a", "word"), "word", "left")
    strong = -F.col("best.less") >= times * F.col("n")
    rows = checkpoint(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(strong, F.col("best.b")).alias("form"), F.when(strong, -F.col("best.less")).alias("form_n")))
    ends = roots(rows.where("form IS NOT NULL"))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
