"""Toxicity scores by gradient-boosted trees over dense features, calibrated by isotonic regression.

The lexicon is learned from labelled texts: words, and stems (first bytes of words), that toxic texts have far
more often than others. Features are densities of lexicon words, their nearness to second-person words, capitals,
punctuation and obfuscation (letters swapped for digits and signs, drawn-out letters). Training takes at most
``MOST_LABELLED`` labelled rows, those with the least hashes of their ids; all rows are scored.

The lexicon that turns a training row into features is learned from the other half of the rows, and the
calibration sees predictions of trees that did not see the row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastra.llm.common import Words, fresh, mix64, text_slices, words_of

#: Labelled rows that the model is fitted on, at most.
MOST_LABELLED = 12_000
#: What makes a term of the lexicon: so many toxic texts, or this share of them, so large log odds, and how sure they are.
LEAST_TEXTS, LEAST_SHARE, LEAST_ODDS, LEAST_SURE = 3, 0.004, 1.5, 2.2
#: Bytes of the stems beside whole words.
STEMS = (5, 6)
#: Words before and after a lexicon word in which a second-person word counts as near.
NEAR = 5
SECOND_PERSON = "you your yours yourself ya u ur du dich dir dein deine deinen deiner ihr euch euer sie ihnen tu toi te ton ta tes vous votre vos tú ti tus tuyo usted ustedes vosotros vuestro os"
_LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
#: Letters and bytes of other characters are words; in the second table so are digits and signs in place of letters.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256))
SWAPPED = bytes(ord(_LEET[chr(b)]) if chr(b) in _LEET else LETTERS[b] for b in range(256))
FEATURES = (
    "words", "strong", "strong_density", "weak", "weak_density", "weight", "weight_density", "kinds", "near_second", "near_second_share", "second_density",
    "capitals", "capital_runs", "exclaims", "questions", "other_marks", "doubled_marks", "inner_signs", "drawn_out", "swapped_hits",
)


def _hashes(words: list[str]) -> np.ndarray:
    raw = " ".join(words).encode()
    return np.unique(words_of(raw, np.array([0, len(raw)]), LETTERS).hashes)


def terms_of(words: Words) -> list[np.ndarray]:
    """Hashes of the words, and of each stem length; where a word is not longer than a stem, of the word."""
    out = [words.hashes]
    array = np.frombuffer(words.data, np.uint8).astype(np.uint64)
    for size in STEMS:
        total = np.full(len(words.start), size, np.uint64)
        for k in range(size):
            at = np.minimum(words.start + k, len(array) - 1)
            total = total * np.uint64(0x9E3779B97F4A7C15) + np.where(words.start + k < words.end, array[at], np.uint64(0))
        out.append(np.where(words.end - words.start > size, mix64(total), words.hashes))
    return out


class Lexicon:
    """Term hashes, sorted, with their log odds."""

    def __init__(self, terms: dict[int, float]):
        self.terms = np.array(sorted(terms), np.uint64)
        self.weights = np.array([terms[int(t)] for t in self.terms], float)
        self.strong = float(np.median(self.weights)) if len(self.weights) else 0.0

    def weigh(self, words: Words) -> np.ndarray:
        """Of each word the largest weight of its terms, or 0."""
        best = np.zeros(len(words.hashes))
        if len(self.terms):
            for hashes in terms_of(words):
                at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
                best = np.maximum(best, np.where(self.terms[at] == hashes, self.weights[at], 0.0))
        return best


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=float)])
    return total[bounds[1:]] - total[bounds[:-1]]


def dense(data: bytes, offsets: np.ndarray, lexicon: Lexicon, second: np.ndarray) -> np.ndarray:
    """(texts, features) of texts that lie end to end in ``data``."""
    words = words_of(data, offsets, LETTERS)
    first, n = words.first, np.maximum(np.diff(words.first), 1)
    weight = lexicon.weigh(words)
    hit = weight > 0
    strong = weight >= max(lexicon.strong, 1e-9)
    owner = np.repeat(np.arange(len(n)), np.diff(first))
    you = np.isin(words.hashes, second)
    seen = np.concatenate([[0], np.cumsum(you)])
    low, high = np.maximum(np.arange(len(you)) - NEAR, first[owner]), np.minimum(np.arange(len(you)) + NEAR + 1, first[owner + 1])
    near = hit & (seen[high] > seen[low])
    kinds = np.zeros(len(n))
    at = np.flatnonzero(hit)
    if len(at):
        pairs = np.unique(np.stack([owner[at].astype(np.uint64), words.hashes[at]]), axis=1)
        kinds = np.bincount(pairs[0].astype(int), minlength=len(n)).astype(float)
    other = words_of(data, offsets, SWAPPED)
    swapped = np.maximum(_sums(lexicon.weigh(other) > 0, other.first) - _sums(hit, first), 0)

    array = np.frombuffer(data, np.uint8)
    size = np.maximum(np.diff(offsets), 1)
    upper = (array >= 65) & (array <= 90)
    letter = upper | ((array >= 97) & (array <= 122)) | (array >= 128)
    mark = (array > 32) & (array < 127) & ~letter & ~((array >= 48) & (array <= 57))
    sign = mark | ((array >= 48) & (array <= 57))
    edge = np.zeros(len(array) + 1, bool)
    edge[offsets] = True
    same = np.zeros(len(array), bool)
    same[1:] = (array[1:] == array[:-1]) & ~edge[1:-1]
    before = lambda x: np.append(False, x[:-1])[: len(x)] & ~edge[:-1]
    after = lambda x: np.append(x[1:], False)[: len(x)] & ~edge[1:]
    rate = lambda x: _sums(x, offsets) / size
    out = np.empty((len(n), len(FEATURES)))
    hits, strongs, total = _sums(hit, first), _sums(strong & hit, first), _sums(weight, first)
    nears = _sums(near, first)
    columns = (
        np.log1p(np.diff(first)), np.log1p(strongs), strongs / n, np.log1p(hits), hits / n, np.log1p(total), total / n, kinds,
        np.log1p(nears), nears / np.maximum(hits, 1), _sums(you, first) / n,
        rate(upper), rate(upper & before(upper)), rate(array == 33), rate(array == 63), rate(mark), rate(mark & same),
        rate(sign & before(letter) & after(letter)), rate(letter & same & before(same)), np.log1p(swapped),
    )
    for k, c in enumerate(columns):
        out[:, k] = c
    return out


class Trees:
    """Boosted regression trees of fixed depth for logistic loss, split at quantiles of the features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, *, rounds: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 48, ridge: float = 2.0, least: float = 1.0):
        self.depth = depth
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T] if len(x) else [np.zeros(0)] * x.shape[1]
        binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(self.cuts, x.T)], axis=1)
        mean = (y.sum() + 1) / (len(y) + 2)
        self.base = float(np.log(mean / (1 - mean)))
        self.trees: list[tuple] = []
        score = np.full(len(y), self.base)
        for _ in range(rounds if len(y) and 0 < y.sum() < len(y) else 0):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, np.maximum(p * (1 - p), 1e-9)
            node = np.zeros(len(y), int)
            feature, cut = np.zeros((1 << depth) - 1, int), np.full((1 << depth) - 1, bins + 1)
            for level in range(depth):
                start = (1 << level) - 1
                for k in range(start, 2 * start + 1):
                    rows = np.flatnonzero(node == k)
                    best = (1e-6, 0, bins + 1)
                    G, H = g[rows].sum(), h[rows].sum()
                    for f in range(x.shape[1]):
                        gs = np.cumsum(np.bincount(binned[rows, f], g[rows], bins + 1))[:-1]
                        hs = np.cumsum(np.bincount(binned[rows, f], h[rows], bins + 1))[:-1]
                        gain = np.where((hs >= least) & (H - hs >= least), gs**2 / (hs + ridge) + (G - gs) ** 2 / (H - hs + ridge) - G**2 / (H + ridge), 0)
                        if len(gain) and gain.max() > best[0]:
                            best = (float(gain.max()), f, int(gain.argmax()))
                    feature[k], cut[k] = best[1:]
                    node[rows] = 2 * k + 1 + (binned[rows, best[1]] > best[2])
            leaf = node - (1 << depth) + 1
            value = rate * np.bincount(leaf, g, 1 << depth) / (np.bincount(leaf, h, 1 << depth) + ridge)
            self.trees.append((feature, cut, value))
            score += value[leaf]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(self.cuts, x.T)], axis=1)
        score = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), int)
            for _ in range(self.depth):
                node = 2 * node + 1 + (binned[rows, feature[node]] > cut[node])
            score += value[node - (1 << self.depth) + 1]
        return score


class Isotonic:
    """A rising step function by pooling adjacent violators, read between the blocks' means by lines."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        order = np.argsort(x, kind="stable")
        blocks: list[list[float]] = []  # weight, sum of y, sum of x
        for a, b in zip(x[order].tolist(), y[order].tolist()):
            blocks.append([1.0, b, a])
            while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
                last = blocks.pop()
                blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
        self.x = np.array([s / w for w, _, s in blocks]) if blocks else np.zeros(1)
        self.y = np.array([s / w for w, s, _ in blocks]) if blocks else np.zeros(1)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.interp(x, self.x, self.y)


class Model:
    def __init__(self, lexicon: Lexicon, x: np.ndarray, y: np.ndarray, fold: np.ndarray):
        self.lexicon = lexicon
        self.trees = Trees(x, y)
        unseen = np.zeros(len(y))
        for k in range(3):
            rest = fold % 3 == k
            unseen[rest] = Trees(x[~rest], y[~rest])(x[rest]) if rest.any() else 0
        self.calibrate = Isotonic(unseen, y)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        raw = self.trees(x)
        return np.clip(0.999 * self.calibrate(raw) + 0.001 / (1 + np.exp(-raw)), 0, 1)


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(fold, toxic, text) -> (term, t0, c0, t1, c1): texts with the term, toxic or not, by fold."""
    for batch in batches:
        fold, toxic = (batch.column(k).to_numpy(zero_copy_only=False).astype(int) for k in (0, 1))
        for row, data, offsets in text_slices(batch.column(2)):
            words = words_of(data, offsets, LETTERS)
            terms, kinds, every = [], [], terms_of(words)
            for d, (i, j) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist())):
                own = np.unique(np.concatenate([t[i:j] for t in every]))
                terms.append(own)
                kinds.append(np.full(len(own), 2 * fold[row + d] + 1 - toxic[row + d]))
            found, inverse = np.unique(np.concatenate(terms), return_inverse=True)
            counts = np.bincount(inverse * 4 + np.concatenate(kinds), minlength=4 * len(found)).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), *(pa.array(counts[:, k]) for k in range(4))], names=["term", "t0", "c0", "t1", "c1"])


def _scored(t: str, c: str, toxic: int, clean: int) -> tuple[F.Column, F.Column]:
    """Log odds of a term that ``t`` of the toxic and ``c`` of the clean texts have, and whether it is one of the lexicon."""
    a, b = F.col(t), F.col(c)
    odds = F.log((a + 0.5) / (toxic + 1)) - F.log((b + 0.5) / (clean + 1))
    sure = odds / F.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
    return odds, (a >= max(LEAST_TEXTS, LEAST_SHARE * toxic)) & (odds > LEAST_ODDS) & (sure > LEAST_SURE)


def fit(documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model from ``labels`` (id, label 1 or 0) of ``documents``; rows without a label teach nothing.

    Of an id with several labels the largest counts. Without a label of each kind the score is about a constant.
    """
    spark = documents.sparkSession
    chosen = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(label_col).cast("int").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("id"), "id").limit(MOST_LABELLED)
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # at most MOST_LABELLED rows of two numbers are broadcast
    sample = docs.join(F.broadcast(chosen), "id").select(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(6)).alias("fold"), "toxic", "text")
    halves = sample.select(F.pmod("fold", F.lit(2)).alias("fold"), "toxic", "text")
    totals = halves.groupBy("fold", "toxic").count().collect()
    size = {(r.fold, r.toxic): r["count"] for r in totals}
    t0, c0, t1, c1 = (size.get(k, 0) for k in ((0, 1), (0, 0), (1, 1), (1, 0)))
    counted = halves.mapInArrow(_term_counts, "term long, t0 long, c0 long, t1 long, c1 long").groupBy("term").agg(*(F.sum(c).alias(c) for c in ("t0", "c0", "t1", "c1")))
    counted = counted.withColumn("t", F.col("t0") + F.col("t1")).withColumn("c", F.col("c0") + F.col("c1"))
    # for each half the lexicon of the other, and that of both. A term is in LEAST_SHARE of at most MOST_LABELLED texts,
    # so that a lexicon has at most 1 / LEAST_SHARE times the terms of a text
    each = [_scored("t1", "c1", t1, c1), _scored("t0", "c0", t0, c0), _scored("t", "c", t0 + t1, c0 + c1)]
    weights = [F.when(taken, odds).alias(f"w{k}") for k, (odds, taken) in enumerate(each)]
    rows = counted.select("term", *weights).where("w0 IS NOT NULL OR w1 IS NOT NULL OR w2 IS NOT NULL").collect()
    *lexicons, final = (Lexicon({r["term"] & (1 << 64) - 1: r[f"w{k}"] for r in rows if r[f"w{k}"] is not None}) for k in range(3))
    shared, second = spark.sparkContext.broadcast(lexicons), _hashes(SECOND_PERSON.split())

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fold = batch.column(0).to_numpy()
            for row, data, offsets in text_slices(batch.column(2)):
                own = fold[row : row + len(offsets) - 1] % 2
                both = [dense(data, offsets, lexicon, second) for lexicon in shared.value]
                x = np.where(own[:, None] == 0, both[0], both[1])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(x)), batch.column(1).slice(row, len(x)), pa.array(x.tolist(), pa.list_(pa.float64()))], names=["fold", "toxic", "x"])

    rows = sample.mapInArrow(kernel, "fold long, toxic int, x array<double>").collect()
    rows.sort(key=lambda r: (r.fold, r.toxic, r.x))
    x = np.array([r.x for r in rows]).reshape(-1, len(FEATURES))
    return Model(final, x, np.array([float(r.toxic) for r in rows]), np.array([r.fold // 2 for r in rows]))


def score(documents: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """``documents`` with ``score`` from 0 to 1. A null or empty text has a score as well."""
    shared, second = documents.sparkSession.sparkContext.broadcast(model), _hashes(SECOND_PERSON.split())
    at, name = documents.columns.index(text_col), fresh(documents.columns, "score")
    frame = documents.withColumn(name, F.lit(0.0))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value(dense(data, offsets, shared.value.lexicon, second)) for _, data, offsets in text_slices(batch.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate([np.zeros(0), *found]))], names=[*batch.schema.names, name])

    return documents.mapInArrow(kernel, frame.schema)
