"""Leaks against a word-by-word search, and edge cases."""

from __future__ import annotations

import random
import re
import unicodedata

import numpy as np
import pytest

from editlume.llm import leakage as L
from editlume.llm.leakage import find_leaks

WORD = re.compile(r"[^\W_]+")


def norm(t):
    t = "".join(c for c in unicodedata.normalize("NFKC", t) if unicodedata.category(c) != "Cf")
    return WORD.findall(t.lower())


def brute(docs, items, run=12, size=3, share=0.5):
    out = set()
    for d, t in docs:
        for i, u in items:
            if None in (d, t, i, u):
                continue
            a, b = norm(t), norm(u)
            grams = lambda w, n: {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
            s = grams(b, size)
            if s and (grams(a, run) & grams(b, run) or len(grams(a, size) & s) >= share * len(s) - 1e-12):
                out.add((d, i))
    return out


def frames(spark, docs, items):
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, item_id long, has_run string")
    i = spark.createDataFrame([(*r, 1, "x") for r in items], "item_id long, text string, doc_id long, edits string")
    return d, i


def found(spark, docs, items, **kw):
    return {(r.doc_id, r.item_id): r for r in find_leaks(*frames(spark, docs, items), **kw).collect()}


def corpus(seed):
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choice("abcdefgé") for _ in range(rnd.randrange(1, 8))) for _ in range(150)]
    text = lambda n: [rnd.choice(vocab) for _ in range(n)]
    items = [(k, text(rnd.choice([4, 8, 14, 30, 60]))) for k in range(40)]
    docs = []
    for d in range(150):
        w = text(rnd.randrange(0, 120))
        for _ in range(rnd.randrange(3)):
            src = rnd.choice(items)[1]
            a = rnd.randrange(len(src))
            part = src[a : a + rnd.choice([5, 11, 12, 13, 30, 60])]
            for _ in range(rnd.randrange(4)):
                part[rnd.randrange(len(part))] = rnd.choice(vocab)
            if rnd.random() < 0.3:  # reordered halves
                part = part[len(part) // 2 :] + part[: len(part) // 2]
            p = rnd.randrange(len(w) + 1)
            w = w[:p] + part + w[p:]
        docs.append((d, rnd.choice([" ", ", ", "\n* "]).join(x.upper() if rnd.random() < 0.2 else x for x in w)))
    return docs, [(k, " ".join(w)) for k, w in items]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_search(spark, seed):
    docs, items = corpus(seed)
    want = brute(docs, items)
    assert len(want) > 20 and set(found(spark, docs + docs[:5], items)) == want


def test_blocks_of_items_give_the_same(spark):
    docs, items = corpus(4)
    assert set(found(spark, docs, items, block_chars=300)) == brute(docs, items)
    assert set(found(spark, docs, items, block_chars=300, blocks_a_pass=1)) == brute(docs, items)


def test_short_items_meet_by_their_sequences():
    """Items too short for a bound of q-grams are compared only with texts that have a word sequence of theirs."""
    index = L.build_index([7, 8], ["a b c", "d e f g"], 12, 3, 0.5)
    assert len(index.short_hash) == 3
    _, w = L._reduce(["x a b c y", "a b x c", "e f g", "", "d e f g a b c"])
    assert {(int(d), int(index.ids[i])) for d, i in zip(*L.short_pairs(index, w, 3))} == {(0, 7), (2, 8), (4, 7), (4, 8)}


def test_edge_cases(spark):
    item = "The quick brown fox jumps over the lazy dog while twelve words pass by here today"
    bent = "the quick bro\xadwn FOX, jumps (over) the lazy dog; while twelve words — pass"
    docs = [(1, bent), (2, None), (None, item), (3, ""), (4, "a b c"), (5, "x " * 50_000 + item + " y" * 50_000), (5, "x"), (6, "ﬁne ﬁsh")]
    items = [(1, item), (1, item), (2, "a b"), (3, "a b c"), (4, None), (None, item), (5, ""), (6, "fine fish here fine fish here"), (7, "日本語 テスト")]
    got = found(spark, docs, items)
    assert set(got) == brute(docs, items) == {(1, 1), (4, 3), (5, 1)}
    assert got[(5, 1)].has_run and got[(5, 1)].shared == 1.0 and got[(5, 1)].edits <= 2
    assert found(spark, [], items) == {} and found(spark, docs, []) == {}


def test_banded_distance_is_the_edit_distance_in_a_wide_band():
    def semi(a, b):
        row = [0] * (len(b) + 1)
        best = len(a)
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1, i))
            row = new
            best = min(best, min(row) + len(a) - i)
        return best

    rnd = random.Random(0)
    a = ["".join(rnd.choice("ab ") for _ in range(rnd.randrange(5, 20))) for _ in range(20)]
    b = ["".join(rnd.choice("ab ") for _ in range(rnd.randrange(5, 20))) for _ in range(20)]
    ia, ib = L.to_batch(a), L.to_batch(b)
    k = np.arange(20)
    got = L.banded_distance(ia, k, ib, k, np.full(20, -32), 64)
    assert got.tolist() == [semi(x, y) for x, y in zip(a, b)]
