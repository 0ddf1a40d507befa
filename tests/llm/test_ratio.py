from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

from cadastra.llm import queries, ratio


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def base(text):
    text = text or ""
    words = plain_words(text)
    windows = defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i : i + 8])].append(i)
    repeated = {k for at in windows.values() if len(at) > 1 for i in at for k in range(i, i + 8)}
    seen, doubled = set(), 0
    for line in text.split("\n"):
        if plain_words(line):
            doubled += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), doubled, len(repeated), failed


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def hash_text(x, seed=42):
    return xxhash.xxh64_intdigest(x.encode(), seed)


def hash_long(x, seed=42):
    return xxhash.xxh64_intdigest((x % (1 << 64)).to_bytes(8, "little"), seed)


def plain_judged(docs, trusted):
    """[(doc_id, counts, failed, kept, score)]: counts of n-grams in dictionaries, one text after the other."""
    fold = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 4
    grams = []
    for id_, lang, text in docs:
        one = [signed(hash_text(w)) for w in plain_words(text)]
        both = one + [signed(hash_long(b, hash_long(a))) for a, b in zip(one, one[1:])]
        grams.append([signed(hash_long(g, hash_text(lang or ""))) % ratio.BUCKETS for g in both])
    raw, target = defaultdict(Counter), defaultdict(Counter)
    for (id_, lang, _), g in zip(docs, grams):
        raw[lang or ""].update(g)
        if id_ is not None and id_ in trusted and fold(id_) != 0:
            target[lang or ""].update(g)
    expected, hits = Counter(), Counter()
    for lang in raw:
        share = sum(target[lang].values()) / max(1, sum(raw[lang].values()))
        if share:
            for b, n in raw[lang].items():
                expected[b] += math.floor(n * share * 1000 + 0.5)
            hits.update(target[lang])
    weight = {b: round(math.log((hits[b] + ratio.SMOOTHING) / (e / 1000 + ratio.SMOOTHING)) * 1e6) for b, e in expected.items()}
    scores = [sum(weight.get(b, 0) for b in g) / len(g) / 1e6 if g else None for g in grams]
    back = defaultdict(list)
    for (id_, lang, _), s in zip(docs, scores):
        if id_ is not None and id_ in trusted and fold(id_) == 0 and s is not None:
            back[lang or ""].append(math.floor(s * 1000))
    least = {}
    for lang, bins in back.items():
        if len(bins) >= ratio.LEAST_TEXTS:
            middle, low = np.quantile(bins, [0.5, 0.1])
            least[lang] = (middle - ratio.DECILES_BELOW * max(1, middle - low)) / 1000
    out = []
    for (id_, lang, text), s in zip(docs, scores):
        counts = base(text)
        out.append((id_, *counts, not counts[-1] and (s is None or (lang or "") not in least or s >= least[lang or ""]), s))
    return out


def same(found, wanted):
    key = lambda r: tuple(map(repr, r[:-1])) + (round(r[-1] or 0, 4),)
    found, wanted = sorted(found, key=key), sorted(wanted, key=key)
    assert len(found) == len(wanted)
    for a, b in zip(found, wanted):
        assert a[:-1] == b[:-1] and (a[-1] is None) == (b[-1] is None) and (a[-1] is None or abs(a[-1] - b[-1]) < 5e-6), (a, b)


def rows_of(frame):
    return [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept, r.score) for r in frame.collect()]


TEXTS = [
    None, "", " \t\n\x0b\x0c\r", "a", "a b c d e f g h " * 9, "# * $%&|<> é ß " * 7, "one\n\n one\none\n\n one\n\t\n", "\x1c\x85 x y",
    " ".join(map(str, range(30))) + "\n" + " ".join(map(str, range(5, 25))), "x " * 19, "x " * 20, " ".join(f"w{i % 9}" for i in range(40)), "😀 " * 30 + "\r\n" * 5,
    " ".join(map(str, range(100))) + " 1 2 3 4 5 6 7 8 " + " ".join(map(str, range(200, 300))) + " 7 8 9 10 11 12 13 14 15",
]


def corpus(rng):
    good = ["the", "of", "and", "water", "stone", "river,", "field.", "old", "new", "house"]
    docs = []
    for i in range(500):
        words = [rng.choice(good) if rng.random() < 0.8 else f"n{rng.randrange(900)}" for _ in range(rng.randrange(20, 120))]
        junk = i % 7 == 0
        docs.append((i, rng.choice(["en", None]), " ".join(f"{w.upper()}!!" for w in words) if junk else " ".join(words), junk))
    return docs


def test_against_plain_counts(spark):
    rng = random.Random(3)
    docs = [d[:3] for d in corpus(rng)] + [(1000 + i, "en", t) for i, t in enumerate(TEXTS)] + [(5, "xx", "again " * 25), (None, "en", "the old house " * 3)]
    trusted = {i for i in range(500) if i % 7 and i % 3} | {1000, 1001}
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, lang string, text string, Bucket string, trusted int")
    known = spark.createDataFrame([(i, 1) for i in trusted] + [(None, 1), (1000, 2)], "doc_id long, lang int")
    found = rows_of(ratio.judged(frame, known))
    same(found, plain_judged(docs, trusted))
    junk = {i for i in range(500) if i % 7 == 0}
    assert not any(r[7] for r in found if r[0] in junk)
    assert all(r[7] for r in found if r[0] in trusted and not r[6])


def test_texts_of_every_kind(spark):
    frame = spark.createDataFrame([(i, "en", t) for i, t in enumerate(TEXTS)], "doc_id long, lang string, text string")
    none = spark.createDataFrame([], "doc_id long")
    found = {r.doc_id: r for r in ratio.judged(frame, none).collect()}
    for i, t in enumerate(TEXTS):
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(t), t
        assert r.kept == (not r.base_failed)


def test_random_repeats(spark):
    rng = random.Random(8)
    texts = [rng.choice([" ", "\n"]).join(rng.choice("abc") for _ in range(rng.randrange(0, 300))) for _ in range(60)] + ["q " * 30_000]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("doc_id", "text", "'' AS lang")
    rows = ratio.scored(frame, spark.createDataFrame([], "bucket long, weight long")).collect()
    assert {(r.id, r.n_dup_lines, r.n_repeat_words) for r in rows} == {(i, *base(t)[3:5]) for i, t in enumerate(texts)}


def test_empty_and_native(spark):
    docs = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert ratio.judged(docs, spark.createDataFrame([], "doc_id long")).count() == 0
    rows = ratio.scored(spark.createDataFrame([(1, "a", "b")], "doc_id long, lang string, text string"), spark.createDataFrame([(1, 1)], "bucket long, weight long"))
    plan = rows._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SortAggregate" not in plan


def test_no_lambda_hashes_grams(spark):
    """A lambda is interpreted for each element, and translate makes a string of each character: most of what the operator took."""
    frame = spark.createDataFrame([(1, "en", "b c")], "doc_id long, lang string, text string")
    rows = ratio.scored(frame, spark.createDataFrame([(1, 1)], "bucket long, weight long"))
    assert "translate(" not in rows._jdf.queryExecution().optimizedPlan().toString()
    grams = ratio._grams(ratio._texts(frame, "doc_id", "lang", "text"), "id", "lang")
    plan = grams._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" in plan and "xxhash64" in plan and "lambda" not in plan


def test_spaces_and_short_repeats(spark):
    rng = random.Random(21)
    gaps = [" ", "\t", "\n", "\x0b", "\x0c", "\r", "  ", "\r\n", " \n\n "]
    # some of four to seven words twice, which no window of eight is, and some of eight and nine
    texts = []
    for n in [1, 2, 3, 4, 5, 6, 7, 8, 9] * 4:
        some = [rng.choice(["é", "$x", "\x1c", "\u2003y", "😀", "a|b"]) + str(i) for i in range(n)]
        words = [f"u{i}" for i in range(rng.randrange(3))] + some + [f"v{i}" for i in range(rng.randrange(1, 9))] + some + ["w"] * rng.randrange(2)
        texts.append(rng.choice(["", *gaps]) + "".join(w + rng.choice(gaps) for w in words))
    frame = spark.createDataFrame([(i, "en", t) for i, t in enumerate(texts)], "doc_id long, lang string, text string")
    found = {r.doc_id: r for r in ratio.judged(frame, spark.createDataFrame([], "doc_id long")).collect()}
    for i, t in enumerate(texts):
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(t), t
    assert {bool(r.n_repeat_words) for r in found.values()} == {True, False}


def test_the_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.lang, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    trusted = {r.doc_id for r in spark.read.parquet(f"{folder}/labels.parquet").where("quality = 1").collect()}
    same(rows_of(queries.op12_ratio(spark, folder)), plain_judged(docs, trusted))


def plain_least(rows, trusted):
    """{lang: least} of (id, lang, score): by a language's own kept-back texts, or else by those of all languages with counted ones."""
    fold = lambda i: zlib.crc32(str(i).encode()) % 4
    rows = [r for r in rows if r[0] in trusted and r[2] is not None]
    counted = {lang for i, lang, _ in rows if fold(i)}
    back = [(lang, math.floor(s * 1000)) for i, lang, s in rows if not fold(i)]
    least = {}
    for lang in {r[1] for r in rows}:
        bins = [b for of, b in back if of == lang]
        if len(bins) < ratio.LEAST_TEXTS:
            bins = [b for of, b in back if of in counted] if lang in counted else []
        if len(bins) >= ratio.LEAST_TEXTS:
            middle, low = np.quantile(bins, [0.5, 0.1])
            least[lang] = (middle - ratio.DECILES_BELOW * max(1, middle - low)) / 1000
    return least


def test_thresholds_of_languages_with_few_texts(spark):
    rng = random.Random(11)
    kept_back, counted = [[i for i in range(4000) if (zlib.crc32(str(i).encode()) % 4 == 0) == k] for k in (True, False)]

    def held(langs, wanted):
        rows = [(i, lang, None if rng.random() < 0.1 else rng.gauss(0.01, 0.03)) for lang, b, c in langs for i in rng.sample(kept_back, b) + rng.sample(counted, c)]
        trusted = {r[0] for r in rows}
        rows += [(5000 + i, "none", -0.5) for i in range(30)]
        frame = spark.createDataFrame(rows, "id long, lang string, score double")
        known = spark.createDataFrame([(i,) for i in trusted], "doc_id long")
        found = {r.lang: r.least for r in ratio.thresholds(frame, known).collect()}
        assert set(found) == wanted
        plain = plain_least(rows, trusted)
        assert set(found) == set(plain) and all(abs(found[k] - plain[k]) < 1e-9 for k in plain)

    held([("many", 60, 90), ("few", 9, 20), ("one", 1, 2), ("no", 0, 15), ("uncounted", 9, 0), ("alone", 60, 0)], {"many", "few", "one", "no", "alone"})
    held([("a", 12, 30), ("b", 14, 30), ("c", 11, 1)], {"a", "b", "c"})
    held([("a", 5, 30), ("b", 4, 30)], set())


def test_few_texts_of_a_language_are_judged(spark):
    docs = corpus(random.Random(5))
    few = [(1000 + i, "de", " ".join(f"Q{j % 31}!!" for j in range(i, i + 25)) if junk else text, junk) for i, (_, _, text, junk) in enumerate(docs[:60])]
    trusted = [i for i, _, _, junk in docs + few if not junk and i % 3]
    back = sum(i >= 1000 and zlib.crc32(str(i).encode()) % 4 == 0 for i in trusted)
    assert 0 < back < ratio.LEAST_TEXTS
    frame = spark.createDataFrame([d[:3] for d in docs + few], "doc_id long, lang string, text string")
    found = {r.doc_id: r for r in ratio.judged(frame, spark.createDataFrame([(i,) for i in trusted], "doc_id long")).collect()}
    assert not any(found[i].kept for i, _, _, junk in few if junk)
    assert all(found[i].kept for i in trusted if not found[i].base_failed)
