"""Quality rules over whole texts and a hashed n-gram likelihood ratio, in DataFrame functions only.

Two multinomials over hashed words and word pairs are counted: trusted texts and all texts. A text's score is the mean
log ratio of the two over its n-grams. All counts of a language's corpus are scaled to the size of its trusted texts and both sides
get the same pseudo counts, so that what is rare says nothing and what the corpus has and trusted texts have not speaks
against a text. Weights are whole numbers (micronats), so that sums don't depend on their order, and a threshold over
binned scores of trusted texts that were kept from counting decides alike in every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadastra.llm.common import checkpoint

#: Cells of the table of weights. It is broadcast: 1 MiB as rows of two longs, whatever the corpus.
BUCKETS = 1 << 16
#: Pseudo counts of each cell on both sides.
SMOOTHING = 8.0
#: Trusted texts with this remainder of their id's crc32 are not counted; they set the threshold.
FOLDS, KEPT_BACK = 4, 0
#: The threshold lies so many times the distance from the median to the lower decile below the median.
DECILES_BELOW = 6.0
#: A language with fewer kept-back texts takes the threshold of all languages' kept-back texts together. If these are fewer
#: as well, it has none, and the ratio rejects none of its texts.
LEAST_TEXTS = 20
#: Scores are told apart down to a thousandth of a nat.
BIN = 1000
#: Ids of trusted texts are broadcast up to this many (64 MB of hashed longs); more of them are joined by a shuffle.
MOST_BROADCAST_IDS = 2_000_000

_SPACE = " \t\n\x0b\x0c\r"
_IN_WORDS = "[^ \\t-\\r]"
_SYMBOL = "[#*$%&|<>]"


def words_of(text: Column) -> Column:
    """The runs of characters other than space and \\t to \\r; none for an empty text."""
    for other in _SPACE[1:]:
        text = F.replace(text, F.lit(other), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def _pairs(values: Column, apart: int) -> Column:
    """Of each element that has another ``apart`` places on: a hash of the two, in order."""
    n = F.greatest(F.size(values) - apart, F.lit(0))
    return F.zip_with(F.slice(values, F.lit(1), n), F.slice(values, F.lit(1 + apart), n), lambda a, b: F.xxhash64(a, b))


def _texts(docs: DataFrame, id_col: str, lang_col: str, text_col: str, *more: Column) -> DataFrame:
    """(id, lang, text, words), and what ``more`` names."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"), text.alias("text"), *more)
    return rows.withColumn("words", words_of(F.col("text")))


def _grams(rows: DataFrame, *keep: str) -> DataFrame:
    """(keep, bucket): two rows for each word, its cell and that of it and the next word, null for the last; without words nulls only.

    Words are hashed as rows beside their next ones, which Spark compiles; a lambda over an array it interprets for each element.
    """
    beside = F.arrays_zip(F.col("words").alias("word"), F.slice("words", F.lit(2), F.size("words")).alias("next"))
    rows = rows.select(*keep, F.explode_outer(beside).alias("w"))
    rows = rows.select(*keep, F.when(F.col("w.word").isNotNull(), F.xxhash64("w.word")).alias("one"), F.when(F.col("w.next").isNotNull(), F.xxhash64("w.next")).alias("next"))
    cell = lambda gram: F.pmod(F.xxhash64("lang", gram), F.lit(BUCKETS)).cast("long")
    one = F.when(F.col("one").isNotNull(), cell("one"))
    two = F.when(F.col("next").isNotNull(), cell(F.xxhash64("one", "next")))
    return rows.select(*keep, F.explode(F.array(one, two)).alias("bucket"))


def _fold(id_: Column) -> Column:
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % FOLDS


def weights(docs: DataFrame, trusted: DataFrame, *, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(bucket, weight): micronats of trusted against all texts for each hashed n-gram, at most ``BUCKETS`` rows.

    All rows of ``docs`` are counted, those whose id is in ``trusted`` (a table with ``id_col``) on both sides.
    Trusted texts that are kept back count on the side of all texts only.
    """
    known = trusted.select(F.col(id_col).alias("id"), F.lit(1).alias("trusted")).where("id IS NOT NULL").distinct()
    known = known.where(_fold(F.col("id")) != KEPT_BACK)
    if known.count() <= MOST_BROADCAST_IDS:
        known = F.broadcast(known)
    marked = docs.select(id_col, lang_col, text_col).join(known.withColumnRenamed("id", id_col), id_col, "left")
    rows = _texts(marked, id_col, lang_col, text_col, F.coalesce("trusted", F.lit(0)).alias("trusted"))
    grams = _grams(rows, "lang", "trusted").where("bucket IS NOT NULL")
    counts = grams.groupBy("lang", "bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("trusted").alias("target"))
    counts = checkpoint(counts)
    totals = counts.groupBy("lang").agg((F.sum("target") / F.sum("raw")).alias("share"))
    scaled = counts.join(totals, "lang").where("share > 0")
    # whole numbers in thousandths: sums of fractions would depend on their order
    expected = F.sum(F.round(F.col("raw") * F.col("share") * 1000).cast("long")) / 1000
    cells = scaled.groupBy("bucket").agg(F.sum("target").alias("target"), expected.alias("expected"))
    ratio = F.log((F.col("target") + SMOOTHING) / (F.col("expected") + SMOOTHING))
    return checkpoint(cells.select("bucket", F.round(ratio * 1_000_000).cast("long").alias("weight")))


def _measures() -> list[Column]:
    """The counts that the rules judge, over ``text``, ``words`` and ``eight``, the hashes of eight words in a row."""
    text, words = F.col("text"), F.col("words")
    n = lambda c: c.cast("long")
    chars = F.length(F.array_join(words, ""))
    symbols = F.regexp_count(text, F.lit(_SYMBOL))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(_IN_WORDS))
    repeats = F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x)))[0]
    return [n(F.size(words)).alias("n_words"), n(chars).alias("word_chars"), n(symbols).alias("n_symbols"), n(repeats).alias("n_dup_lines"), n(_repeated_words()).alias("n_repeat_words")]


def _repeated_words() -> Column:
    """Words that lie in a window of eight words which the text has twice or more.

    Most texts have none, which distinct hashes of their fours or eights tell (``eight`` is null where all fours differ).
    In the others windows are sorted by hash; one is repeated if a neighbour has its hash. Their places in order, the
    words each adds to those before are counted.
    """
    eight = F.col("eight")
    placed = F.array_sort(F.transform(eight, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(s: Column) -> Column:
        last = F.size(s) - 1
        same = lambda k: ((k > 0) & (F.get(s, k - 1)["h"] == F.get(s, k)["h"])) | ((k < last) & (F.get(s, k + 1)["h"] == F.get(s, k)["h"]))
        return F.array_sort(F.transform(F.filter(F.sequence(F.lit(0), last), same), lambda k: F.get(s, k)["i"]))

    start = F.struct(F.lit(0).alias("words"), F.lit(0).alias("end"))
    add = lambda acc, i: F.struct((acc["words"] + i + 8 - F.greatest(acc["end"], i)).alias("words"), (i + 8).alias("end"))
    covered = F.transform(F.array(placed), lambda s: F.aggregate(places(s), start, add)["words"])[0]
    return F.when(eight.isNull() | (F.size(eight) == F.size(F.array_distinct(eight))), 0).otherwise(covered)


def scored(docs: DataFrame, table: DataFrame, *, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(id, lang, the five counts, score) for each row of ``docs``; score is in nats per n-gram, null without words.

    ``table`` is that of ``weights``, bounded by ``BUCKETS`` rows, and is broadcast. Each text is read once: its n-grams
    are looked up and summed in the task that reads it, and one row for a text is shuffled.
    """
    rows = _texts(docs, id_col, lang_col, text_col).withColumn("two", _pairs(F.col("words"), 1)).withColumn("four", _pairs(F.col("two"), 2))
    rows = rows.withColumn("eight", F.when(F.size("four") > F.size(F.array_distinct("four")), _pairs(F.col("four"), 4)))
    rows = rows.select(F.monotonically_increasing_id().alias("at"), "id", "lang", *_measures(), "words")
    every = ["at", "id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    met = _grams(rows, *every).join(F.broadcast(table), "bucket", "left")
    summed = met.groupBy(*every).agg(F.sum(F.coalesce("weight", F.lit(0))).alias("total"), F.count("bucket").alias("grams"))
    return summed.select(*every[1:], (F.col("total") / F.when(F.col("grams") > 0, F.col("grams")) / 1_000_000).alias("score"))


def thresholds(rows: DataFrame, trusted: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """(lang, least) from the kept-back trusted texts among ``rows`` of ``scored``.

    The median and the lower decile of binned scores are exact and set the least score: ``DECILES_BELOW`` times their
    distance, at least a bin, below the median, so that a few odd trusted texts can't move it. A language with fewer than
    ``LEAST_TEXTS`` of them, but with trusted texts that were counted, is judged by those of all such languages together, as scores
    are normalised by language. A language without counted texts has no weights of its own: others say nothing of it.
    """
    known = trusted.select(F.col(id_col).alias("id")).where("id IS NOT NULL").distinct()
    mine = rows.where("score IS NOT NULL").select("id", "lang", F.floor(F.col("score") * BIN).alias("bin"), (_fold(F.col("id")) == KEPT_BACK).alias("back"))
    bins = checkpoint(mine.join(known, "id", "left_semi").groupBy("lang", "bin").agg(F.count_if("back").alias("n"), F.count_if(~F.col("back")).alias("counted")))
    spread = lambda name: F.percentile("bin", F.array(F.lit(0.5), F.lit(0.1)), F.col("n")).alias(name)
    own = bins.groupBy("lang").agg(F.sum("n").alias("n"), F.sum("counted").alias("counted"), spread("q"))
    every = bins.join(own.where("counted > 0").select("lang"), "lang", "left_semi").agg(F.sum("n").alias("n"), spread("q"))
    apart = F.greatest(F.col("q")[0] - F.col("q")[1], F.lit(1.0))
    least = F.when(F.col("n") >= LEAST_TEXTS, (F.col("q")[0] - DECILES_BELOW * apart) / BIN)
    together = every.select(least).scalar()
    return own.select("lang", F.coalesce(least, F.when(F.col("counted") > 0, together)).alias("least")).where("least IS NOT NULL")


def judged(docs: DataFrame, trusted: DataFrame, *, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score, least), a row for each row of ``docs``.

    ``base_failed``: fewer than 20 words, or over 30 % of the words in repeated windows of eight. ``kept``: the base has not
    failed and the score is not below the least of its language (null: '') by ``thresholds``. A null or empty text has no words and fails
    the base. Rows that repeat an id are judged each by their text; a null id is never trusted. Without trusted texts
    only the base decides. An empty table gives no rows; further columns of ``docs`` and ``trusted`` are not looked at.
    """
    names = {"id_col": id_col, "lang_col": lang_col, "text_col": text_col}
    rows = checkpoint(scored(docs, weights(docs, trusted, **names), **names))
    found = rows.join(thresholds(rows, trusted, id_col=id_col), "lang", "left")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    kept = ~failed & F.coalesce(F.col("score") >= F.col("least"), F.lit(True))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return found.select(F.col("id").alias("doc_id"), *counts, failed.alias("base_failed"), kept.alias("kept"), "score", "least")
