"""Near duplicates against all pairs, and edge cases."""

from __future__ import annotations

import random
import re

import pytest

from editlume.llm import near_dups
from editlume.llm.near_dups import expand_pairs, near_duplicate_classes, near_duplicate_groups

WORD = re.compile(r"[^\W_]+")
SCHEMA = "rev_id long, text string, id long, rep string, key int, grams string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, "y") for r in rows], SCHEMA)


def brute(rows, size, threshold, least):
    sets = {}
    for i, t in rows:
        if i is None or t is None:
            continue
        w = [x.lower() for x in WORD.findall(t)]
        if len(w) >= least:
            sets[i] = set(zip(*[w[k:] for k in range(size)]))
    ids = sorted(sets)
    return {(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-12}


def corpus(seed, edits=10, n=60):
    rnd = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)]
    boiler = [rnd.choice(vocab) for _ in range(12)]  # in every text
    rows = []
    for k in range(n):
        base = boiler + [rnd.choice(vocab) for _ in range(rnd.choice([25, 80, 200]))]
        for c in range(rnd.choice([1, 1, 3, 6])):
            words = list(base)
            for _ in range(rnd.randrange(0, len(words) // edits + 1)):
                p = rnd.randrange(len(words))
                op = rnd.random()
                if op < 0.4:
                    words[p] = rnd.choice(vocab)
                elif op < 0.6:
                    del words[p]
                elif op < 0.8:
                    words.insert(p, rnd.choice(vocab))
                else:
                    q = rnd.randrange(len(words))
                    words = words[min(p, q) :] + words[: min(p, q)] if rnd.random() < 0.3 else words
            rows.append((1000 * k + c, " ".join(words).title() if rnd.random() < 0.3 else ", ".join(words)))
    return rows


@pytest.mark.parametrize("size, threshold, edits", [(3, 0.6, 10), (5, 0.8, 40)])
def test_recall_against_all_pairs(spark, size, threshold, edits):
    rows = corpus(size, edits)
    want = brute(rows, size, threshold, 20)
    m, links = near_duplicate_classes(frame(spark, rows + rows[:9]), "rev_id", "text", size, threshold, 20)
    got = {(r.a, r.b) for r in expand_pairs(m, links).collect()}
    assert len(want) > 50 and got <= want
    assert len(got) >= 0.998 * len(want), want - got  # each pair is missed with probability below 1 / 1,000


def test_edge_cases(spark):
    long = " ".join(f"x{k % 977} y{k}" for k in range(30_000))
    few = "only a few words"
    base = " ".join(f"a{k}" for k in range(30))
    rows = [(1, base), (2, base.upper()), (2, base.upper()), (3, base + " tail"), (4, None), (None, base), (5, ""), (6, few), (7, few), (8, long), (9, long + " z"), (10, "é " * 25)]
    m, links = near_duplicate_classes(frame(spark, rows), "rev_id", "text", 3, 0.6, 20)
    assert {(r.a, r.b) for r in expand_pairs(m, links).collect()} == {(1, 2), (1, 3), (2, 3), (8, 9)}
    assert {(r.id, r.rep, r.n_copies) for r in m.collect()} == {(1, 1, 2), (2, 1, 2), (3, 3, 1), (8, 8, 1), (9, 9, 1), (10, 10, 1)}
    g = {r.id: (r.group_id, r.n_copies) for r in near_duplicate_groups(frame(spark, rows), "rev_id", "text", 3, 0.6, 20).collect()}
    assert g == {1: (1, 2), 2: (1, 2), 3: (1, 1), 8: (8, 1), 9: (8, 1), 10: (10, 1)}


def test_many_copies_stay_one_class(spark):
    base = " ".join(f"a{k}" for k in range(30))
    m, links = near_duplicate_classes(frame(spark, [(k, base) for k in range(500)]), "rev_id", "text", 3, 0.6, 20)
    assert links.count() == 0 and m.count() == 500 and m.select("rep").distinct().count() == 1


def variant(rnd, words, k):
    """`words` with four words of its own, so that any two variants share at least 94 of at most 142 sequences."""
    own = list(words)
    for p in rnd.sample(range(len(own)), 4):
        own[p] = f"own{k}x{p}"
    return " ".join(own)


def test_large_group_of_variants(spark):
    rnd, n = random.Random(7), 1500
    words = [f"g{k}" for k in range(120)]
    m, links = near_duplicate_classes(frame(spark, [(k, variant(rnd, words, k)) for k in range(n)]), "rev_id", "text", 3, 0.6, 20)
    assert links.count() == n * (n - 1) // 2


def test_copies_and_one_variant(spark):
    rnd, rows = random.Random(8), []
    for g in range(8):
        words = [f"g{g}w{k}" for k in range(120)]
        rows += [(10_000 * g + k, " ".join(words)) for k in range(3000)] + [(10_000 * g + 9999, variant(rnd, words, g))]
    m, links = near_duplicate_classes(frame(spark, rows), "rev_id", "text", 3, 0.6, 20)
    assert {(r.a, r.b) for r in links.collect()} == {(10_000 * g, 10_000 * g + 9999) for g in range(8)}


def test_chain_of_groups(spark):
    words = [f"c{k}" for k in range(200)]
    rows = [(k, " ".join(words[5 * k : 5 * k + 60])) for k in range(25)]  # neighbours are alike, ends are not
    assert {r.group_id for r in near_duplicate_groups(frame(spark, rows), "rev_id", "text", 3, 0.6, 20).collect()} == {0}


def test_two_texts_under_one_id(spark):
    a, b = ([f"{x}{k}" for k in range(60)] for x in "ab")
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, " ".join([*a, "tail"])), (3, " ".join([*b, "tail"])), (4, " ".join(a))]
    m, links = near_duplicate_classes(frame(spark, rows), "rev_id", "text", 3, 0.6, 20)
    assert {(r.a, r.b) for r in expand_pairs(m, links).collect()} == {(1, 2), (1, 3), (1, 4), (2, 4)}
    g = {(r.id, r.group_id) for r in near_duplicate_groups(frame(spark, rows), "rev_id", "text", 3, 0.6, 20).collect()}
    assert g == {(1, 1), (2, 1), (3, 1), (4, 1)}


@pytest.mark.parametrize("size, threshold, edits", [(3, 0.6, 10), (5, 0.8, 40)])
def test_groups_are_components_of_all_pairs(spark, size, threshold, edits):
    rows = corpus(size + 10, edits)
    least = {i: i for i, t in rows if len(WORD.findall(t)) >= 20}
    pairs = brute(rows, size, threshold, 20)
    for _ in range(30):
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
    assert {r.id: r.group_id for r in near_duplicate_groups(frame(spark, rows), "rev_id", "text", size, threshold, 20).collect()} == least


def test_groups_compare_in_proportion(spark, monkeypatch):
    """A group of n variants takes about n comparisons of whole sets, not n squared; two groups alike below the threshold stay two."""
    asked = []
    real = near_dups.Meeting.links
    monkeypatch.setattr(near_dups.Meeting, "links", lambda self, pairs: asked.append(pairs.count()) or real(self, pairs))
    rnd, counts = random.Random(9), {}
    for n in (100, 300):
        asked.clear()
        words = [f"g{k}" for k in range(120)]
        other = [*words[:50], *[f"h{k}" for k in range(70)]]
        rows = [(k, variant(rnd, words, k)) for k in range(n)] + [(1000, " ".join(other)), (1001, " ".join([*other, "x"]))]
        got = {r.id: r.group_id for r in near_duplicate_groups(frame(spark, rows), "rev_id", "text", 3, 0.6, 20).collect()}
        assert got == {**dict.fromkeys(range(n), 0), 1000: 1000, 1001: 1000}
        counts[n] = sum(asked)
    assert counts[300] < 12 * 300 and counts[300] < 4.5 * counts[100], counts


def test_pairs_of_many_copies(spark):
    base = " ".join(f"a{k}" for k in range(30))
    m, links = near_duplicate_classes(frame(spark, [(k, base) for k in range(700)]), "rev_id", "text", 3, 0.6, 20)
    assert expand_pairs(m, links).count() == expand_pairs(m, links, 10).count() == 700 * 699 // 2


def test_filter_of_many_ids(spark, monkeypatch):
    rows = corpus(3, 10, 20)
    want = brute(rows, 3, 0.6, 20)
    monkeypatch.setattr(near_dups, "FILTER_IDS", 1)
    m, links = near_duplicate_classes(frame(spark, rows), "rev_id", "text", 3, 0.6, 20)
    assert {(r.a, r.b) for r in expand_pairs(m, links).collect()} == want


def test_chance_pairs_are_not_stored(spark, monkeypatch):
    """Texts that share a third of their sequences meet, by keys and by prefixes, but only pairs that may be links are written."""
    stored, real = [], near_dups.materialize

    def counted(df, name):
        out = real(df, name)
        if out.columns == ["a", "b"]:
            stored.append(out.count())
        return out

    monkeypatch.setattr(near_dups, "materialize", counted)
    monkeypatch.setattr(near_dups, "PART_ROWS", 1500, raising=False)
    rows = [(k, " ".join([f"o{k}x{j}" for j in range(20)] + [f"s{j}" for j in range(20)])) for k in range(160)]
    rows += [(1000 + k, " ".join([f"t{k}x{j}" for j in range(20)] + [f"g{k // 10}s{j}" for j in range(20)])) for k in range(60)]
    rows += [(i + 5000, t + " tail") for i, t in rows[-6:]]
    m, links = near_duplicate_classes(frame(spark, rows), "rev_id", "text", 3, 0.6, 20)
    assert {(r.a, r.b) for r in links.collect()} == brute(rows, 3, 0.6, 20) == {(1054 + k, 6054 + k) for k in range(6)}
    assert stored and max(stored) < 1000, stored  # 9,794 before


def shuffled_rows(spark, act):
    """Rows that the stages of `act` write to shuffles."""
    sc = spark.sparkContext
    store = lambda: sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
    stages = lambda: {s.stageId(): s.shuffleWriteRecords() for s in (store().apply(k) for k in range(store().size()))}
    before = stages()
    act()
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    return sum(n for k, n in stages().items() if k not in before)


def test_segments_are_shuffled_once(spark):
    """Anchors of 60 texts that share a third: a segment is one row of one shuffle, and is not written for each code word index."""
    rows = [(100 * g + k, " ".join([f"o{g}x{k}x{j}" for j in range(30)] + [f"s{g}x{j}" for j in range(30)])) for g in range(8) for k in range(60)]
    rows.append((9999, rows[0][1] + " tail"))
    found = []
    small = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(small, "-1")  # so small a table would not be shuffled at all
    try:
        n = shuffled_rows(spark, lambda: found.extend((r.a, r.b) for r in near_duplicate_classes(frame(spark, rows), "rev_id", "text", 3, 0.6, 20)[1].collect()))
    finally:
        spark.conf.unset(small)
    assert found == [(0, 9999)]
    assert n < 3 * len(rows) * near_dups.SLOTS, n  # 54,211 before


def test_anchors_larger_than_a_task(spark, monkeypatch):
    """Anchors that count as too frequent for a task's memory, with keys over several batches and crowded ones, give the same."""
    rnd = random.Random(12)
    words = [f"g{k}" for k in range(120)]
    rows = corpus(13) + [(10**6 + k, variant(rnd, words, k)) for k in range(300)]
    want = brute(rows, 3, 0.6, 20)
    least = {i: i for i, t in rows if len(WORD.findall(t)) >= 20}
    for _ in range(30):
        for a, b in want:
            least[a] = least[b] = min(least[a], least[b])
    monkeypatch.setattr(near_dups, "LOCAL_LEVEL", 1)
    crowd, real = [], near_dups.crowd_pairs
    monkeypatch.setattr(near_dups, "crowd_pairs", lambda c, *a: crowd.append(c.texts.count()) or real(c, *a))
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(batch, "100")
    try:
        m, links = near_duplicate_classes(frame(spark, rows), "rev_id", "text", 3, 0.6, 20)
        got = {(r.a, r.b) for r in expand_pairs(m, links).collect()}
        groups = {r.id: r.group_id for r in near_duplicate_groups(frame(spark, rows), "rev_id", "text", 3, 0.6, 20).collect()}
    finally:
        spark.conf.unset(batch)
    assert got <= want and len(got) >= 0.998 * len(want), want - got
    assert crowd and crowd[0] >= 300, crowd
    assert groups == least


def test_empty(spark):
    m, links = near_duplicate_classes(frame(spark, []), "rev_id", "text")
    assert m.count() == 0 and links.count() == 0 and expand_pairs(m, links).count() == 0
    assert near_duplicate_groups(frame(spark, []), "rev_id", "text").count() == 0
