from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np

from cadastra.llm import quality
from cadastra.llm.quality import ORDER


def sequence(text):
    return ["\x02"] * (ORDER - 1) + list(text) + ["\x03"]


class Brute:
    """Interpolated modified Kneser-Ney by the book, on character tuples."""

    def __init__(self, texts):
        top = Counter(tuple(s[i : i + ORDER]) for s in map(sequence, texts) for i in range(len(s) - ORDER + 1))
        self.counts = {ORDER: top}
        for n in range(ORDER - 1, 0, -1):
            plain = Counter(tuple(s[i : i + n]) for s in map(sequence, texts) for i in range(ORDER - n, len(s) - n + 1))
            before = defaultdict(set)
            for s in map(sequence, texts):
                for i in range(ORDER - n, len(s) - n + 1):
                    before[tuple(s[i : i + n])].add(s[i - 1])
            self.counts[n] = Counter({g: plain[g] if g[0] == "\x02" else len(before[g]) for g in plain})
        self.cuts, self.contexts = {}, {}
        for n, counts in self.counts.items():
            few = Counter(counts.values())
            y = few[1] / max(few[1] + 2 * few[2], 1)
            self.cuts[n] = [min(max(k - (k + 1) * y * few[k + 1] / max(few[k], 1), 0.1), k - 0.1) for k in (1, 2, 3)]
            self.contexts[n] = defaultdict(lambda: [0, 0.0])
            for g, c in counts.items():
                self.contexts[n][g[:-1]][0] += c
                self.contexts[n][g[:-1]][1] += self.cuts[n][min(c, 3) - 1]

    def p(self, gram):
        if not gram:
            return 1 / (1 << quality.BITS)
        n = len(gram)
        lower = self.p(gram[1:])
        if gram[:-1] not in self.contexts[n]:
            return lower
        total, cut = self.contexts[n][gram[:-1]]
        c = self.counts[n][gram]
        return (c - self.cuts[n][min(c, 3) - 1] if c else 0) / total + cut / total * lower

    def bits(self, text):
        s = sequence(text)
        return -sum(math.log2(self.p(tuple(s[i : i + ORDER]))) for i in range(len(s) - ORDER + 1))


def corpus(n=240):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        lang = ("en", "fr", "xx", None)[min(i % 7, 3)]
        words = ["the", "of", "réou", "ation", "ing", "an"] if lang == "en" else ["le", "dé", "élan", "que"]
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))
        if i % 10 == 9:
            text = "".join(rng.choice("%$#@!|XQZ日") for _ in range(rng.randint(30, 200)))
        rows.append((i, text, lang))
    return [*rows, (9001, None, "en"), (9002, "", "zz"), (None, "the of", "en"), (9003, "the of " * 40_000, "en")]


def frames(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, KEPT int").repartition(4)
    trusted = spark.createDataFrame([(r[0],) for r in rows if r[0] is not None and r[0] % 10 != 9 and r[0] < 9000] + [(None,), (77777,)], "doc_id long")
    return rows, docs, trusted


def test_perplexities_are_those_of_the_book(spark, monkeypatch):
    monkeypatch.setattr(quality, "OWN_MODEL_TEXTS", 30)
    rows, docs, trusted = frames(spark)
    model = quality.fit(docs, trusted, quantile=0.99)
    assert {"en", "fr"} <= set(model.languages)
    good = trusted.join(docs, "doc_id").selectExpr("coalesce(lang, '*') AS lang", "text", "pmod(xxhash64(doc_id, 3), 4) AS part").collect()
    own = {number: Brute([r.text for r in good if r.part != 0 and (lang is None or r.lang == lang)]) for lang, number in [*model.languages.items(), (None, 0)]}
    found = quality.score(docs, model)
    assert found.columns == ["doc_id", "text", "lang", "KEPT", "perplexity", "threshold", "kept_"]
    kept, wrong = [], []
    for r in found.collect():
        number = model.languages.get(r.lang or "*", 0)
        average, limit = model.threshold.get(number, model.threshold[0])
        text = r.text or ""
        if len(text) < 1000:
            bits = (own[number].bits(text) + 32 * average) / (len(text) + 1 + 32)
            assert math.isclose(r.perplexity, 2**bits, rel_tol=1e-6)
            assert r.kept_ == (math.log2(r.perplexity) <= limit + 1e-12)
        (wrong if r.doc_id is not None and r.doc_id % 10 == 9 and r.doc_id < 9000 else kept).append(r.kept_)
    # about ten texts set each limit here, so that one in eleven exceeds it by chance
    assert sum(kept) / len(kept) > 0.85 and sum(wrong) / len(wrong) < 0.05


def test_sharded_form_gives_the_same(spark, monkeypatch):
    _, docs, trusted = frames(spark)
    model = quality.fit(docs, trusted)
    one = {r.doc_id: round(r.perplexity, 9) for r in quality.score(docs, model).collect()}
    monkeypatch.setattr(quality, "BROADCAST_ENTRIES", 0)
    monkeypatch.setattr(quality, "BLOCK_CHARACTERS", 2000)
    limits, model = model.threshold, quality.fit(docs, trusted)
    assert model.shared is None and model.threshold.keys() == limits.keys()
    assert all(np.allclose(model.threshold[k], limits[k]) for k in limits)
    assert {r.doc_id: round(r.perplexity, 9) for r in quality.score(docs, model).collect()} == one


def test_nothing_trusted_and_empty(spark):
    _, docs, trusted = frames(spark)
    model = quality.fit(docs, trusted.limit(0))
    rows = quality.score(docs, model).collect()
    assert all(r.kept_ and r.threshold is None for r in rows) and len(rows) == docs.count()
    assert quality.score(docs.limit(0), model).count() == 0


def test_packed_bounds():
    alphabets = quality.Alphabets({1: [ord("a"), ord("日")], 2: [ord("a")]})
    grams, starts = quality.packed(["ab", "", "日"], np.array([1, 2, 1]), alphabets)
    assert starts.tolist() == [0, 3, 4, 6] and len(grams) == 6
    top = quality.BITS * ORDER
    assert (grams >> top).tolist() == [1, 1, 1, 2, 1, 1]
    last = (1 << quality.BITS) - 1
    assert (grams & last).tolist() == [4, 0, 3, 3, 5, 3]  # b is unknown to model 1
    assert [(g >> quality.BITS) & last for g in grams.tolist()] == [2, 4, 0, 2, 2, 5]


def test_each_character_of_an_alphabet_is_told_apart(spark):
    """Languages beyond the Latin script: a text in another order of the same script's characters is much less likely."""
    rng = random.Random(6)
    words = ["".join(chr(0x4E00 + rng.randrange(1500)) for _ in range(3)) for _ in range(60)]
    rows = [(i, "".join(rng.choice(words) for _ in range(60)), "zh") for i in range(80)]
    odd = [(1000 + i, "".join(rng.sample(r[1], len(r[1]))), "zh") for i, r in enumerate(rows[:20])]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")
    model = quality.fit(docs, docs.where("doc_id < 1000"))
    found = {r.doc_id: r.kept for r in quality.score(docs, model).collect()}
    assert not any(found[i] for i, _, _ in odd) and sum(found[i] for i, _, _ in rows) >= 78
