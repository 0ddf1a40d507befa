"""Quality by the perplexity of an interpolated modified Kneser-Ney model of characters.

Trusted texts are counted in full. Tasks count what they hold and Spark adds up; joins of the count tables, sharded
by language and n-gram, give continuation counts, discounts, back-off weights and from them the interpolated
probability of every n-gram seen. N-grams at the start of a text have no left neighbours and keep their plain counts.
A language's alphabet is learned: its most frequent characters have codes of their own, as many as there are codes,
and all others are one unknown character. A text's probability is then looked up, longest n-gram first. Character
models stay small next to their corpus, so tables of up to ``BROADCAST_ENTRIES`` are broadcast, after they are counted.
Beyond it the lookup is a sharded join as well (``_sharded``): texts are dealt into blocks, a block's distinct
n-grams are joined with the tables, and each block reads its texts with the answers.

Texts are rejected beyond a quantile of their language's trusted texts that the model has not been trained on. A
language with few of them is judged with the model of all trusted texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadastra.llm.common import SLICE_BYTES, fresh, release, squeezed, text_slices, unsqueezed, written

#: Characters of an n-gram.
ORDER = 5
#: Bits of a character in a packed n-gram. The rest of 62 bits has the number of the language's model.
BITS = 11
#: Codes of unknown characters and of a text's start and end; those of an alphabet follow.
_UNKNOWN, _BEGIN, _END, _FIRST = 0, 2, 3, 4
#: Languages that can have models of their own: those with the most trusted texts.
MOST_MODELS = (1 << (62 - BITS * ORDER)) - 1
#: A language has a model of its own with so many trusted texts.
OWN_MODEL_TEXTS = 40
#: One trusted text in so many is kept from training and sets the threshold.
CALIBRATION = 4
#: Characters of average text that each text's mean is mixed with, so that a few letters condemn nothing.
PRIOR_CHARACTERS = 32
#: Table entries up to which they are broadcast: 16 bytes each.
BROADCAST_ENTRIES = 4_000_000
#: Characters of the texts of a block in the sharded form, on average.
BLOCK_CHARACTERS = 16_000_000
ALL = "*"


class Alphabets:
    """The characters that each model has codes for."""

    def __init__(self, characters: dict[int, list[int]]):
        self.characters = characters
        self.tables: dict[int, np.ndarray] = {}

    def __getstate__(self):
        return self.characters

    def __setstate__(self, characters):
        self.__init__(characters)

    def codes(self, characters: np.ndarray, model: int) -> np.ndarray:
        if model not in self.tables:
            table = np.zeros(0x110000, np.int64)
            known = self.characters.get(model, [])
            table[known] = np.arange(_FIRST, _FIRST + len(known))
            self.tables[model] = table
        return self.tables[model][characters]


def packed(texts: list[str], languages: np.ndarray, alphabets: Alphabets) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams, bounds): the n-gram that ends at each character and at the end of each text, with the number of
    its model above it; bounds of the texts among them."""
    lengths = np.array([len(t) for t in texts], np.int64)
    characters = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), lengths)
    own = np.empty(len(characters), np.int64)
    for model in np.unique(languages).tolist():
        of = np.flatnonzero(languages[owner] == model) if len(characters) else np.empty(0, np.int64)
        own[of] = alphabets.codes(characters[of], model)
    bounds = np.concatenate([[0], np.cumsum(lengths + ORDER)])
    codes = np.full(bounds[-1], _BEGIN, np.int64)
    codes[bounds[1:] - 1] = _END
    codes[np.arange(len(characters)) + (ORDER - 1) + owner * ORDER] = own
    grams = np.zeros(max(0, len(codes) - ORDER + 1), np.int64)
    for k in range(ORDER):
        grams = (grams << BITS) | codes[k : len(codes) - ORDER + 1 + k]
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    ends = np.arange(starts[-1]) + np.repeat(np.arange(len(texts)), lengths + 1) * (ORDER - 1)
    return grams[ends] | (np.repeat(languages.astype(np.int64), lengths + 1) << (BITS * ORDER)), starts


def _texts(batch: pa.RecordBatch, text_at: int) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of a column of texts or of squeezed ones, some at a time."""
    if pa.types.is_binary(batch.column(text_at).type):
        row, held, size = 0, [], 0
        for raw in unsqueezed(batch.column(text_at)):
            held.append(raw.decode())
            size += len(raw)
            if size > SLICE_BYTES:
                yield row, held
                row, held, size = row + len(held), [], 0
        if held:
            yield row, held
        return
    for row, data, offsets in text_slices(batch.column(text_at)):
        bounds = offsets.tolist()
        yield row, [data[a:b].decode() for a, b in zip(bounds, bounds[1:])]


def _characters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(model, text) -> (model, character, n)."""
    for batch in batches:
        models = batch.column(0).to_numpy()
        for row, texts in _texts(batch, 1):
            own = models[row : row + len(texts)]
            for model in np.unique(own).tolist():
                text = "".join(t for t, m in zip(texts, own.tolist()) if m == model)
                found, n = np.unique(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), model)), pa.array(found.astype(np.int64)), pa.array(n)], names=["model", "character", "n"])


def _alphabets(texts: DataFrame) -> Alphabets:
    """Of each model the most frequent characters of its (model, text), as many as there are codes."""
    counts = texts.mapInArrow(_characters, "model long, character long, n long").groupBy("model", "character").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("model").orderBy(F.desc("n"), "character"))
    kept = counts.withColumn("rank", rank).where(F.col("rank") <= (1 << BITS) - _FIRST)
    lists = kept.groupBy("model").agg(F.array_sort(F.collect_list("character")).alias("characters"))
    return Alphabets({r.model: r.characters for r in lists.collect()})


def _count(alphabets: Alphabets):
    """(model, text) -> (gram, n), added up in the task."""

    def merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        found, inverse = np.unique(np.concatenate([g for g, _ in held]), return_inverse=True)
        return found, np.bincount(inverse, np.concatenate([n for _, n in held])).astype(np.int64)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            models = batch.column(0).to_numpy()
            for row, texts in _texts(batch, 1):
                held.append(np.unique(packed(texts, models[row : row + len(texts)], alphabets)[0], return_counts=True))
                if len(held) >= 16:
                    held = [merged(held)]
                    if len(held[0][0]) > 1_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in held.pop()], names=["gram", "n"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in merged(held)], names=["gram", "n"])

    return kernel


@dataclass
class Model:
    languages: dict[str, int]  # those with a model of their own; the others have number 0
    seen: list[DataFrame]  # of each length from 1: (gram, p)
    backoff: list[DataFrame]  # of each length from 1: (context, gamma) of its contexts
    threshold: dict[int, tuple[float, float]]  # of each model: average bits a character, most bits
    alphabets: Alphabets
    shared: object = None  # the broadcast tables, where they are small enough

    def share(self, spark) -> None:
        entries = sum(f.count() for f in (*self.seen, *self.backoff))
        if entries <= BROADCAST_ENTRIES:
            self.shared = spark.sparkContext.broadcast(Tables(_arrays(self.seen), _arrays(self.backoff)))

    def number(self, language) -> F.Column:
        """The number of a language's model; null and unknown languages have 0."""
        table = F.create_map(*(F.lit(x) for kv in self.languages.items() for x in kv)) if self.languages else None
        return F.coalesce(table[F.coalesce(language.cast("string"), F.lit(ALL))], F.lit(0)).cast("long") if self.languages else F.lit(0).cast("long")


_GRAM = (1 << BITS * ORDER) - 1


def _suffix(gram, n: int):
    """An n-gram's last n - 1 characters, its language kept."""
    language = F.shiftrightunsigned(gram, BITS * ORDER)
    return F.shiftleft(language, BITS * ORDER).bitwiseOR(gram.bitwiseAND(F.lit((1 << BITS * (n - 1)) - 1)))


def _context(gram, n: int):
    """An n-gram without its last character; the language stays above the first ORDER characters."""
    language = F.shiftrightunsigned(gram, BITS * ORDER)
    return F.shiftleft(language, BITS * ORDER).bitwiseOR(F.shiftrightunsigned(gram.bitwiseAND(F.lit(_GRAM)), BITS))


def _tables(counts: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """Seen n-grams with their interpolated probabilities and contexts with their back-off weights, by length."""
    language = F.shiftrightunsigned("gram", BITS * ORDER).alias("language")
    levels = [counts]
    for n in range(ORDER, 1, -1):
        shorter = levels[0].groupBy(_suffix(F.col("gram"), n).alias("gram")).agg(F.count(F.lit(1)).alias("types"), F.sum("n").alias("times"))
        at_start = F.shiftrightunsigned(F.col("gram").bitwiseAND(F.lit((1 << BITS * (n - 1)) - 1)), BITS * (n - 2)) == _BEGIN
        levels.insert(0, written(shorter.select("gram", F.when(at_start, F.col("times")).otherwise(F.col("types")).alias("n"))))
    seen: list[DataFrame] = []
    backoff: list[DataFrame] = []
    for n, level in enumerate(levels, 1):
        few = level.groupBy(language).agg(*(F.sum((F.col("n") == k).cast("double")).alias(f"n{k}") for k in (1, 2, 3, 4)))
        y = F.col("n1") / F.greatest(F.col("n1") + 2 * F.col("n2"), F.lit(1.0))
        cuts = [F.least(F.greatest(k - (k + 1) * y * F.col(f"n{k + 1}") / F.greatest(F.col(f"n{k}"), F.lit(1.0)), F.lit(0.1)), F.lit(k - 0.1)) for k in (1, 2, 3)]
        # one row for each language
        discounts = F.broadcast(few.select("language", *(c.alias(f"d{k}") for k, c in enumerate(cuts, 1))))
        off = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        rows = level.withColumn("language", language).join(discounts, "language").select("gram", F.col("n").cast("double").alias("n"), off.alias("off"), _context(F.col("gram"), n).alias("context"))
        contexts = written(rows.groupBy("context").agg(F.sum("n").alias("total"), (F.sum("off") / F.sum("n")).alias("gamma")))
        rows = rows.join(contexts, "context")
        own = (F.col("n") - F.col("off")) / F.col("total")
        if n == 1:
            found = rows.select("gram", (own + F.col("gamma") / (1 << BITS)).alias("p"))
        else:
            lower = seen[-1].select(F.col("gram").alias("suffix"), F.col("p").alias("q"))
            found = rows.withColumn("suffix", _suffix(F.col("gram"), n)).join(lower, "suffix").select("gram", (own + F.col("gamma") * F.col("q")).alias("p"))
        seen.append(written(found))
        backoff.append(contexts.select("context", "gamma"))
    return seen, backoff


class Tables:
    """The tables of a model as sorted arrays, looked up by bisection."""

    def __init__(self, seen: list[tuple[np.ndarray, np.ndarray]], backoff: list[tuple[np.ndarray, np.ndarray]]):
        self.seen = [self._sorted(*x) for x in seen]
        self.backoff = [self._sorted(*x) for x in backoff]

    @staticmethod
    def _sorted(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(keys)
        return keys[order], values[order]

    @staticmethod
    def _find(table: tuple[np.ndarray, np.ndarray], wanted: np.ndarray, missing: float) -> tuple[np.ndarray, np.ndarray]:
        keys, values = table
        if not len(keys):
            return np.zeros(len(wanted), bool), np.full(len(wanted), missing)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        found = keys[at] == wanted
        return found, np.where(found, values[at], missing)

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """Of each n-gram, sorted: minus the binary logarithm of its probability."""
        out = np.empty(len(grams))
        open_, current, factor = np.arange(len(grams)), grams, np.ones(len(grams))
        for n in range(ORDER, 0, -1):
            found, p = self._find(self.seen[n - 1], current, 0.0)
            out[open_[found]] = factor[found] * p[found]
            open_, current, factor = open_[~found], current[~found], factor[~found]
            language = current >> (BITS * ORDER) << (BITS * ORDER)
            factor = factor * self._find(self.backoff[n - 1], language | ((current & _GRAM) >> BITS), 1.0)[1]
            current = language | (current & ((1 << BITS * (n - 1)) - 1))
        out[open_] = factor / (1 << BITS)
        return -np.log2(out)


def _score_texts(lookup, texts: list[str], languages: np.ndarray, alphabets: Alphabets) -> tuple[np.ndarray, np.ndarray]:
    """(bits, characters) of each text, its end counted as a character."""
    grams, starts = packed(texts, languages, alphabets)
    distinct, inverse = np.unique(grams, return_inverse=True)
    bits = lookup(distinct)[inverse]
    return np.add.reduceat(bits, starts[:-1]), np.diff(starts)


def _arrays(frames: list[DataFrame]) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for frame in frames:
        table = frame.toArrow()
        out.append((table.column(0).to_numpy(), table.column(1).to_numpy()))
    return out


def _scored(documents: DataFrame, model: Model, number, text_col: str, names: list[str]) -> DataFrame:
    """``documents`` with the number of the model, bits and characters."""
    rows = documents.withColumn(names[0], number).withColumn(names[1], F.lit(0.0)).withColumn(names[2], F.lit(0).cast("long"))
    shared = model.shared
    if shared is None:
        return _sharded(rows, model, text_col, names)
    model_at, text_at = rows.columns.index(names[0]), rows.columns.index(text_col)
    alphabets = model.alphabets

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages = batch.column(model_at).to_numpy()
            parts = [_score_texts(shared.value.bits, texts, languages[row : row + len(texts)], alphabets) for row, texts in _texts(batch, text_at)]
            if parts:
                yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *(pa.array(np.concatenate(x)) for x in zip(*parts))], names=batch.schema.names)

    return rows.mapInArrow(kernel, rows.schema)


def _block_grams(alphabets: Alphabets):
    """(block, model, text) -> distinct (block, gram) of each slice."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks, languages = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for row, texts in _texts(batch, 2):
                own = blocks[row : row + len(texts)]
                for b in np.unique(own):
                    at = np.flatnonzero(own == b)
                    found = np.unique(packed([texts[i] for i in at], languages[row : row + len(texts)][at], alphabets)[0])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), b)), pa.array(found)], names=["block", "gram"])

    return kernel


def _sharded(rows: DataFrame, model: Model, text_col: str, names: list[str]) -> DataFrame:
    """The same for tables of any size: the lookup is a join on n-grams, distinct within blocks of texts."""
    spark, seen, backoff, alphabets = rows.sparkSession, model.seen, model.backoff, model.alphabets
    size = rows.agg(F.coalesce(F.sum(F.coalesce(F.length(text_col), F.lit(0)) + 1), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK_CHARACTERS))
    block = fresh(rows.columns, "block")
    dealt = written(rows.withColumn(block, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks))))
    grams = dealt.select(block, names[0], text_col).mapInArrow(_block_grams(alphabets), "block long, gram long").distinct()
    grams = written(grams)
    open_ = grams.select("gram").distinct().select("gram", F.col("gram").alias("q"), F.lit(1.0).alias("factor"), F.lit(None).cast("double").alias("p"))
    for n in range(ORDER, 0, -1):
        open_ = open_.join(seen[n - 1].select(F.col("gram").alias("q"), F.col("p").alias("own")), "q", "left")
        open_ = open_.withColumn("p", F.coalesce("p", F.col("factor") * F.col("own"))).withColumn("context", _context(F.col("q"), n))
        open_ = open_.join(backoff[n - 1], "context", "left").withColumn("factor", F.col("factor") * F.coalesce("gamma", F.lit(1.0)))
        open_ = open_.select("gram", _suffix(F.col("q"), n).alias("q"), "factor", "p")
    answers = open_.select("gram", (-F.log2(F.coalesce("p", F.col("factor") / (1 << BITS)))).alias("bits"))
    known = grams.join(answers, "gram").select("block", "gram", "bits")
    width, schema = len(rows.columns), rows.schema
    model_at, text_at = rows.columns.index(names[0]), rows.columns.index(text_col)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def read(texts: pa.Table, table: pa.Table) -> pa.Table:
        grams_, bits = table.column(1).to_numpy(), table.column(2).to_numpy()
        order = np.argsort(grams_)
        grams_, bits = grams_[order], bits[order]
        lookup = lambda wanted: bits[np.searchsorted(grams_, wanted)]
        out = []
        for batch in texts.to_batches():
            languages = batch.column(model_at).to_numpy()
            parts = [_score_texts(lookup, t, languages[row : row + len(t)], alphabets) for row, t in _texts(batch, text_at)]
            if parts:
                out.append(pa.RecordBatch.from_arrays([*batch.columns[: width - 2], *(pa.array(np.concatenate(x)) for x in zip(*parts))], schema=arrow))
        return pa.Table.from_batches(out, schema=arrow)

    return dealt.groupBy(block).cogroup(known.groupBy("block")).applyInArrow(read, schema)


def fit(documents: DataFrame, trusted: DataFrame, *, quantile: float = 0.98, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model of the texts of ``documents`` whose ids are in ``trusted``, all of them.

    One in ``CALIBRATION`` of them, by a hash of the id, is not trained on; the ``quantile`` of its bits is the
    threshold of its language. Null ids are never trusted; repeated ids are so with all their texts.
    """
    ids = trusted.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("trusted_id")).distinct()
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(lang_col).cast("string"), F.lit(ALL)).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # a join by hashes whatever the sizes: a broadcast of the ids would grow with the labels
    good = squeezed(docs, "text").hint("merge").join(ids, F.col("id") == F.col("trusted_id"), "left_semi")
    good = written(good.select("lang", "text", (F.pmod(F.xxhash64("id", F.lit(3)), F.lit(CALIBRATION)) == 0).alias("kept_back")))
    release(documents.sparkSession)
    many = good.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("kept_back").cast("int")).alias("back")).where((F.col("n") >= OWN_MODEL_TEXTS) & (F.col("back") >= 1))
    largest = many.where(F.col("lang") != ALL).orderBy(F.desc("n"), "lang").limit(MOST_MODELS).collect()
    model = Model({r.lang: k for k, r in enumerate(sorted(largest, key=lambda r: r.lang), 1)}, [], [], {}, Alphabets({}))
    numbered = good.withColumn("model", model.number(F.col("lang")))
    train = numbered.where("NOT kept_back")
    both = train.select("model", "text").unionByName(train.where("model <> 0").select(F.lit(0).cast("long").alias("model"), "text"))
    model.alphabets = _alphabets(both)
    counts = written(both.mapInArrow(_count(model.alphabets), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")))
    model.seen, model.backoff = _tables(counts)
    release(documents.sparkSession)
    model.share(documents.sparkSession)
    back = numbered.where("kept_back")
    names = ["number", "bits", "characters"]
    for every in (False, True):
        chosen = back if not every else back.withColumn("model", F.lit(0).cast("long"))
        scored = _scored(chosen.select("model", "text"), model, F.col("model"), "text", names)
        mean = written(scored.select("model", "bits", "characters"))
        average = {r.model: r.a for r in mean.groupBy("model").agg((F.sum("bits") / F.sum("characters")).alias("a")).collect()}
        for number, a in average.items():
            if every or number:
                own = mean.where(F.col("model") == number).select(((F.col("bits") + PRIOR_CHARACTERS * F.lit(a)) / (F.col("characters") + PRIOR_CHARACTERS)).alias("x"))
                model.threshold[number] = (a, own.agg(F.percentile_approx("x", quantile, 100_000).alias("q")).first()["q"])
    return model


def score(documents: DataFrame, model: Model, *, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``documents`` with perplexity (of a character), threshold (a perplexity) and kept.

    A text's mean bits are mixed with those of ``PRIOR_CHARACTERS`` average characters. A null text is empty, and an
    empty one is judged by its end alone. Without trusted texts the threshold is null and all rows are kept. The
    names of the added columns get underscores where ``documents`` has them. An empty table gives no rows.
    """
    taken = list(documents.columns)
    final = [fresh(taken, x) for x in ("perplexity", "threshold", "kept")]
    names = [fresh([*taken, *final], x) for x in ("number", "bits", "characters")]
    scored = _scored(documents, model, model.number(F.col(lang_col)), text_col, names)
    limits = model.threshold or {0: (0.0, None)}
    pick = lambda k: F.create_map(*(F.lit(x).cast(t) for n, v in limits.items() for x, t in ((n, "long"), (v[k], "double"))))[F.col(names[0])]
    mean = (F.col(names[1]) + PRIOR_CHARACTERS * F.coalesce(pick(0), F.lit(0.0))) / (F.col(names[2]) + PRIOR_CHARACTERS)
    limit = pick(1)
    return scored.select(*(f"`{c}`" for c in taken), F.pow(F.lit(2.0), mean).alias(final[0]), F.pow(F.lit(2.0), limit).alias(final[1]), F.coalesce(mean <= limit, F.lit(True)).alias(final[2]))
