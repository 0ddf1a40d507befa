from __future__ import annotations

import cProfile
import pstats
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cadastra.llm import passages


def tree_windows(values, least):
    """By definition: for each c the largest range in which it is the first least value."""
    out = []
    for c, v in enumerate(values):
        l = r = c
        while l > 0 and values[l - 1] > v:
            l -= 1
        while r + 1 < len(values) and values[r + 1] >= v:
            r += 1
        if r - l + 1 >= least:
            out.append((l, c, r))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(1, 12), max_size=40), min_size=1, max_size=4), st.integers(2, 9))
def test_compact_windows(texts, least):
    values = np.array([v for t in texts for v in t], np.uint32)
    bounds = np.cumsum([0, *map(len, texts)])
    found = sorted(zip(*(x.tolist() for x in passages.compact_windows(values, bounds, least))))
    wanted = [(l + b, c + b, r + b) for t, b in zip(texts, bounds.tolist()) for l, c, r in tree_windows(t, least)]
    assert found == sorted(wanted)


def test_shared_passages():
    rng = random.Random(1)
    fresh = lambda n: [rng.randrange(1 << 40) for _ in range(n)]
    common = fresh(60)
    a, b = fresh(100) + common + fresh(30), fresh(7) + common + fresh(90)
    (found,) = passages.shared_passages(np.array(a, np.uint64), np.array(b, np.uint64), 46, 80)
    assert found == (100, 160, 7, 67)
    b[40:45] = fresh(5)  # one changed word
    assert passages.shared_passages(np.array(a, np.uint64), np.array(b, np.uint64), 46, 80) == [(100, 160, 7, 67)]
    cycle = fresh(30) * 6
    (found,) = passages.shared_passages(np.array(fresh(9) + cycle, np.uint64), np.array(cycle + fresh(60), np.uint64), 46, 80)
    assert found == (9, 189, 0, 180)
    short = fresh(3) + common[:40] + fresh(200)
    assert passages.shared_passages(np.array(a, np.uint64), np.array(short, np.uint64), 46, 80) == []


def test_members_with_repeated_tokens_are_counted_together():
    rng = np.random.default_rng(3)
    least, width = 8, 12

    def counted(n):
        contexts = rng.integers(1, 9, (n, width)).astype(np.uint32)
        for row in contexts:  # a few lie at an end of their text
            row[: rng.integers(0, 3) * 3] = 0
        profile = cProfile.Profile()
        found = profile.runcall(passages._Contexts, contexts, np.zeros(n, np.int64), 1, least, 80)
        for row, fewest, first in zip(contexts, found.fewest, found.first):
            own = row[row != 0].tolist()
            least_sets = min((len(set(own[k : k + least])) for k in range(len(own) - least + 1)), default=len(set(own)))
            assert fewest == (least if len(set(own)) == len(own) else least_sets)
            assert first[row != 0].tolist() == [x not in own[:k] for k, x in enumerate(own)]
        return pstats.Stats(profile).total_calls

    assert counted(400) < counted(50) + 50  # no call for each member


def corpus():
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(5))
    text = lambda n: [word() for _ in range(n)]
    first, second, short = text(60), text(55), text(30)
    phrase = text(7)
    docs, wanted = {}, set()
    for i in range(1, 60):
        body = text(rng.randint(0, 120))
        at = rng.randint(0, len(body))
        if i % 7 == 0:
            body[at:at] = first
            wanted.add(i)
        elif i % 7 == 1:
            body[at:at] = [w.upper() for w in second]
            wanted.add(i)
        elif i % 7 == 2:
            edited = list(first)
            edited[30] = word()
            body[at:at] = edited
            wanted.add(i)
        elif i % 7 == 3:
            body[at:at] = short
        elif i % 7 == 4:
            body[at:at] = phrase
        docs[i] = " ".join(body)
    whole = " ".join(text(200))
    docs |= {100: whole, 101: whole, 102: whole + " " + " ".join(text(10))}
    return docs, wanted | {100, 101, 102}, (first, second)


def test_repeated_and_removed(spark):
    docs, wanted, _ = corpus()
    rows = [*docs.items(), (200, None), (201, ""), (202, "x"), (None, docs[100])]
    frame = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, id int").repartition(4)
    found = {r.doc_id: r for r in passages.repeated(frame).collect()}
    assert set(found) == wanted
    assert {i: r.class_id for i, r in found.items()} == {i: 100 if i >= 100 else 1 if i % 7 == 1 else 2 for i in wanted}
    assert all(r.n_repeated >= 50 and r.n_links >= 1 for r in found.values())
    left = passages.remove_repeats(frame)
    assert left.columns == frame.columns
    texts = {r.doc_id: r.text for r in left.collect() if r.doc_id is not None}
    assert all(texts[i] == docs[i] for i in docs if i not in wanted or i in (1, 2, 100))
    assert texts[101] == "" and len(texts[102].split()) == 10
    assert not passages.repeated(left.where("doc_id IS NOT NULL")).count()


def test_a_frequent_token_hides_no_passage(spark, monkeypatch):
    """Texts with lesser ids share every single token of a passage with it, but no passage."""
    docs, _, (first, _) = corpus()
    rng = random.Random(3)
    pieces = [first[k : k + 25] for k in range(0, 60, 5)]
    noise = lambda n: ["n%d" % rng.randrange(10**9) for _ in range(n)]
    rows = [(i, " ".join(noise(60) + pieces[i % len(pieces)] + noise(60))) for i in range(40)]
    rows += [(1000 + i, " ".join(noise(40) + first + noise(40))) for i in range(3)]
    found = {r.doc_id: r.class_id for r in passages.repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1000: 1000, 1001: 1000, 1002: 1000}


def test_many_partial_quotes_hide_no_passage(spark):
    """Parts of 40 words hold two tokens 22 apart, so that lesser ids stay in the groups under narrowed keys as well."""
    _, _, (first, _) = corpus()
    rng = random.Random(4)
    noise = lambda n: ["n%d" % rng.randrange(10**9) for _ in range(n)]
    rows = [(i, " ".join(noise(60) + first[i % 5 * 5 : i % 5 * 5 + 40] + noise(60))) for i in range(150)]
    rows += [(1000 + i, " ".join(noise(40) + first + noise(40))) for i in range(3)]
    found = {r.doc_id: r.class_id for r in passages.repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1000: 1000, 1001: 1000, 1002: 1000}


def test_repeated_ids_long_texts_and_empty(spark):
    docs, _, _ = corpus()
    long_ = " ".join(f"v{i}" for i in range(60_000))
    rows = [(5, docs[100]), (5, docs[101]), (7, long_), (8, "z " + long_), (9, "be " * 300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in passages.repeated(frame).collect()} == {7, 8}
    assert passages.repeated(frame.limit(0)).count() == 0
    assert passages.remove_repeats(frame.limit(0)).count() == 0


def test_runs_of_other_lengths():
    rng = random.Random(5)
    x, y, z = (rng.randrange(1 << 40) for _ in range(3))
    middle = [rng.randrange(1 << 40) for _ in range(5)]
    a = [x] * 60 + middle + [y] * 30 + [z] * 40
    b = [x] * 22 + middle + [y] * 30 + [z] * 3
    found = passages.shared_passages(np.array(a, np.uint64), np.array(b, np.uint64), 46, 80)
    assert any(e - s >= 55 for *_, s, e in found)


def alike_by_all_windows(a: list[str], b: list[str], least: int = 46, percent: int = 80) -> bool:
    """Whether some ``least`` five-word tokens in a row of either text are alike, by comparing all with all."""
    x, y = ([" ".join(t[i : i + 5]) for i in range(len(t) - 4)] for t in (a, b))
    if min(len(x), len(y)) < least:
        return False
    same = (np.array(x)[:, None] == np.array(y)[None, :]).astype(np.int64)
    sums = np.pad(same.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    common = sums[least:, least:] - sums[:-least, least:] - sums[least:, :-least] + sums[:-least, :-least]
    return bool(((100 + percent) * common >= 2 * percent * least).any())


def test_recall_against_all_pairs(spark):
    """Copies with and without changed words, and parts of them too short for a passage, in texts of lesser ids."""
    rng = random.Random(21)
    word = lambda: "w%d" % rng.randrange(10**9)
    sources = [[word() for _ in range(80)] for _ in range(14)]
    texts = []
    for i in range(260):
        body = [word() for _ in range(rng.randint(5, 60))]
        source = rng.choice(sources)
        if i < 120:
            begin = rng.randrange(len(source) - 36)
            piece = source[begin : begin + rng.randint(25, 43)]
        else:
            size = rng.choice((50, 50, 55, 70, 80))
            begin = rng.randrange(len(source) - size + 1)
            piece = source[begin : begin + size]
            for _ in range(rng.choice((0, 0, 1, 1, 2))):
                piece = list(piece)
                piece[rng.randrange(len(piece))] = word()
        at = rng.randrange(len(body) + 1)
        texts.append(body[:at] + piece + body[at:])
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    found = {r.doc_id: r.class_id for r in passages.repeated(frame).collect()}
    links = [(i, j) for j in range(len(texts)) for i in range(j) if alike_by_all_windows(texts[i], texts[j])]
    held = [found.get(i, -i - 1) == found.get(j, -j - 1) for i, j in links]
    assert len(links) > 200 and sum(held) / len(held) >= 0.99, (len(links), sum(held))
    linked = {k for pair in links for k in pair}
    assert len(linked - found.keys()) <= 0.01 * len(linked) and min(found) >= 120
    whole = {i: {" ".join(t[k : k + 50]) for k in range(len(t) - 49)} for i, t in enumerate(texts)}
    copies = [(i, j) for i, j in links if whole[i] & whole[j]]
    assert len(copies) > 50 and all(found.get(i) is not None and found.get(i) == found.get(j) for i, j in copies)


def test_blocks_and_large_groups_give_the_same(spark, monkeypatch):
    """A group dealt into blocks, and one that first loses members without a partner."""
    _, _, (first, _) = corpus()
    rng = random.Random(4)
    noise = lambda n: ["n%d" % rng.randrange(10**9) for _ in range(n)]
    rows = [(i, " ".join(noise(60) + first[i % 5 * 5 : i % 5 * 5 + 40] + noise(60))) for i in range(90)]
    edited = lambda k: [*first[:k], "new%d" % k, *first[k + 1 :]]
    rows += [(1000 + i, " ".join(noise(40) + edited(i * 4) + noise(40))) for i in range(14)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = None
    for block, many in ((9, 1000), (9, 2)):
        monkeypatch.setattr(passages, "BLOCK", block)
        monkeypatch.setattr(passages, "MANY_BLOCKS", many)
        found = sorted((r.doc_id, r.class_id) for r in passages.repeated(frame).collect())
        assert found == (wanted or found) and {c for _, c in found} == {1000} and len(found) == 14
        wanted = found


def words_by_all_pairs(texts: list[list[str]], least: int = 50) -> dict[int, int]:
    """Of each text the words in stretches of ``least`` words that another text has as they are."""
    holders: dict[tuple, set[int]] = {}
    for i, t in enumerate(texts):
        for k in range(len(t) - least + 1):
            holders.setdefault(tuple(t[k : k + least]), set()).add(i)
    return {i: len({w for k in range(len(t) - least + 1) if len(holders[tuple(t[k : k + least])]) > 1 for w in range(k, k + least)}) for i, t in enumerate(texts)}


def test_words_beyond_the_first_copy(spark):
    """Three texts with a passage, of which the last two have more of it, ahead or behind: all of it is found and removed once."""
    rng = random.Random(13)
    word = lambda: "w%d" % rng.randrange(10**15)
    texts = []
    for k in range(150):
        source, more = [word() for _ in range(120)], rng.choice((3, 10, 20, 30))
        begin = 0 if k % 2 else more
        for size in (60, 60 + more, 60 + more):
            piece = source[begin : begin + size] if k % 2 else source[begin - (size - 60) : begin + 60]
            texts.append([word() for _ in range(rng.randrange(5, 40))] + piece + [word() for _ in range(rng.randrange(5, 40))])
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    found = {r.doc_id: r for r in passages.repeated(frame).collect()}
    exact = words_by_all_pairs(texts)
    # a stretch that is alike as a whole may have a few words of its own at an end; none is too short
    over = [found[i].n_repeated - n for i, n in exact.items()]
    assert all(exact.values()) and min(over) == 0 and max(over) < 10 and sum(x > 0 for x in over) <= 5
    assert all(found[3 * k + j].n_links == 2 for k in range(150) for j in range(3))
    left = {r.doc_id: r.text.split() for r in passages.remove_repeats(frame).collect()}
    kept = [w for i in range(len(texts)) for w in left[i]]
    assert len(kept) == len(set(kept))  # no word of a passage is left twice


def test_continuations_in_many_lengths(spark):
    """Twenty texts, each with three words more of a passage than the one before: each one's longest match is another's."""
    rng = random.Random(14)
    word = lambda: "w%d" % rng.randrange(10**15)
    source = [word() for _ in range(140)]
    texts = [[word() for _ in range(20)] + source[: 52 + 3 * k] + [word() for _ in range(20)] for k in range(20)]
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {r.doc_id: r.n_repeated for r in passages.repeated(frame).collect()}
    assert found == words_by_all_pairs(texts)
