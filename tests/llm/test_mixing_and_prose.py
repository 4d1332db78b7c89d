"""Mixing to target shares; flagged pages on held-out texts of known make."""

from __future__ import annotations

import os
import random

import pytest

from editlume.llm.mixing import count_tokens, mix_sources, rake, rake_rows
from editlume.llm.prose import coder, features, flag_pages, train_on
from editlume.llm.queries import PATTERN, RANKS, TOKENIZERS


def test_rake_meets_sources_and_caps():
    cells = [("a", l, t, n) for l, t, n in (("en", "x", 1000), ("en", "y", 500), ("de", "x", 100))] + [("b", "en", "x", 300), ("b", "de", "y", 200), ("c", "en", "x", 0)]
    targets = {"a": (0.5, 2), "b": (0.4, 1), "c": (0.1, 4), "gone": (0.1, 1)}
    plan = rake(cells, targets)
    size = {s: sum(w * n for (s2, l, t, w) in plan.cells for (s3, l3, t3, n) in cells if (s2, l, t) == (s3, l3, t3) and s2 == s) for s in "ab"}
    assert abs(size["a"] / size["b"] - 1.25) < 1e-6 and abs(sum(size.values()) - plan.total) < 1e-6
    assert all(0 <= w <= targets[s][1] + 1e-9 for s, _, _, w in plan.cells)
    assert rake([], targets).cells == [] and rake([("z", "en", "x", 5)], targets).cells == []


def test_mix(spark):
    rnd = random.Random(1)
    rows = [(k, rnd.choice(["en", "EN-us", None, "de"]), s, rnd.choice([None, 1, 2]), rnd.randrange(1, 400), "x") for k, s in enumerate(["big"] * 3000 + ["mid"] * 600 + ["small"] * 100 + ["other"] * 50)]
    rows += rows[:50] + [(None, "en", "big", 1, 5, "x"), (10**6, "en", None, 1, 5, "x"), (10**6 + 1, "en", "big", 1, 0, "x"), (10**6 + 2, "en", "big", 1, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, source string, topic int, n_tokens long, w string")
    targets = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.3, 2), ("small", 0.15, 4), ("gone", 0.05, 2), ("gone", 0.05, 2), (None, 0.1, 1)], "source string, target_share double, max_repeats int")
    chosen, shares, reached = mix_sources(docs, targets, "doc_id")
    got = {r.source: r for r in shares.collect()}
    assert set(got) == {"big", "mid", "small", "gone"} and got["gone"].actual_share == 0
    for s, share in (("big", 0.5), ("mid", 0.3), ("small", 0.15)):
        assert abs(got[s].actual_share - share / 0.95) < 0.01 and got[s].most_copies <= got[s].max_repeats
    picked = chosen.collect()
    assert len({r.doc_id for r in picked}) == len(picked) and sum(r.n_tokens * r.copies for r in picked if r.source == "big") == got["big"].tokens_mixed
    assert sorted(map(tuple, mix_sources(docs, targets, "doc_id")[0].collect())) == sorted(map(tuple, picked))
    axes = {(r.axis, r.name): r for r in reached.collect()}
    assert all(abs(sum(r.actual_share for (a, _), r in axes.items() if a == axis) - 1) < 1e-9 for axis in ("source", "lang", "topic"))
    assert all(abs(r.actual_share - r.target_share) < 0.02 for (a, _), r in axes.items() if a == "lang") and ("lang", "und") in axes
    empty, none, bare = mix_sources(docs.where("doc_id < 0"), targets, "doc_id")
    assert empty.count() == 0 and none.count() == 4 and bare.count() == 4
    assert mix_sources(docs, targets.where("source = 'x'"), "doc_id")[0].count() == 0


def test_many_cells(spark):
    """More cells than the driver takes: the same weights from aggregates, the same shares."""
    rnd = random.Random(3)
    cells = [(s, l, str(t), rnd.randrange(1, 500)) for s in "abc" for l in ("en", "de") for t in range(12) if rnd.random() < 0.8]
    targets = {"a": (0.5, 2), "b": (0.3, 1), "c": (0.2, 3), "gone": (0.1, 1)}
    want = {(s, l, t): w for s, l, t, w in rake(cells, targets).cells}
    got = {(r.source, r.lang, r.topic): r.w for r in rake_rows(spark.createDataFrame(cells, "source string, lang string, topic string, tokens long"), targets).collect()}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-4 * max(1, want[k]) for k in want)
    docs = spark.createDataFrame([(k, "en", "ab"[k % 2], k % 90, 1 + k % 7) for k in range(4000)], "doc_id long, lang string, source string, topic int, n_tokens long")
    goal = spark.createDataFrame([("a", 0.6, 2), ("b", 0.4, 1)], "source string, target_share double, max_repeats int")
    for driver_cells in (10_000, 20):
        chosen, shares, _ = mix_sources(docs, goal, "doc_id", driver_cells=driver_cells)
        assert all(abs(r.actual_share - r.target_share) < 0.01 and r.most_copies <= r.max_repeats for r in shares.collect())
    assert rake_rows(spark.createDataFrame([], "source string, lang string, topic string, tokens long"), targets).count() == 0


@pytest.mark.skipif(not os.path.exists(f"{TOKENIZERS}/{RANKS}"), reason="no tokenizer files")
def test_token_counts(spark):
    df = spark.createDataFrame([(1, "Hello world", "x"), (2, None, "y"), (3, "", "z"), (4, "<|endoftext|> é日本", "z")], "doc_id long, text string, n string")
    got = {r.doc_id: r.n_tokens for r in count_tokens(df, "text", f"{TOKENIZERS}/{RANKS}", PATTERN).collect()}
    assert got[2] == got[3] == 0 and 2 <= got[1] <= 5 and got[4] > 5


NOUNS = "harbour bridge village river church market castle museum school garden tower library station island forest".split()
VERBS = "stands burned opened closed crossed served joined faced followed supplied".split()


def sentence(rnd):
    n = lambda: rnd.choice(NOUNS)
    return rnd.choice([
        f"The {n()} of {n().title()}ton {rnd.choice(VERBS)} the old {n()} until {rnd.randrange(1500, 1990)}.", f"In the {n()}, a small {n()} was built by the owner of the {n()}.",
        f"It is said that the {n()} and the {n()} were once on the same road to {n().title()}ville.", f"After the war, the {n()} had been sold to a family from the {n()}.",
    ])


def spam(rnd):
    w = rnd.sample("casino loan watches pills viagra cheap best buy free discount".split(), 4)
    return rnd.choice([
        " ".join(rnd.choice(w) for _ in range(60)), "\n".join(f"* [http://{rnd.choice(w)}{k}.test/{rnd.choice(w)} {rnd.choice(w)} {rnd.choice(w)}]" for k in range(15)),
        "#".join(rnd.choice(w) + rnd.choice(w) for _ in range(60)), "\n".join(f"SKU: {k}-X | {rnd.randrange(90)}.99 EUR | {rnd.choice(w)}" for k in range(15)),
    ])


def page(rnd, kind):
    if kind == "prose":
        return rnd.choice([" ", "\n* ", " -- [[User:Xy]] 3 May 2010\n"]).join(sentence(rnd) for _ in range(15))
    prose = " ".join(sentence(rnd) for _ in range(5))
    return spam(rnd) + "\n" + (prose if kind == "mixed" else "") if rnd.random() < 0.5 else (prose if kind == "mixed" else "") + "\n" + spam(rnd)


def test_accuracy(spark):
    rnd = random.Random(2)
    rows = [(k, "spam" if rnd.random() < 0.1 else "prose") for k in range(1500)]
    docs = spark.createDataFrame([(k, page(rnd, kind), kind, 1.0) for k, kind in rows], "doc_id long, text string, flagged string, out double")
    got = {r.doc_id: r.flagged for r in flag_pages(docs).collect()}
    truth = {k: kind == "spam" for k, kind in rows}
    assert sum(got[k] == truth[k] for k in truth) >= 0.99 * len(truth)


def test_same_for_any_partitions(spark):
    rnd = random.Random(4)
    rows = [(k, page(rnd, "spam" if k % 12 == 0 else "prose")[: 200 + k % 100], rnd.choice(["en", None, "EN-us"])) for k in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    one, many = ({tuple(r) for r in flag_pages(d).collect()} for d in (docs.coalesce(1), docs.repartition(7)))
    assert len(one) == 1200 and one == many


def test_small_language(spark):
    """A language with one page in a hundred is read by words of its own, under a wrong label too."""
    rnd = random.Random(5)
    other = str.maketrans("aeiou", "uaeio")  # other words, the same grammar
    rows = [(k, page(rnd, "spam" if k % 15 == 0 else "prose"), "en") for k in range(3000)]
    rows += [(10_000 + k, page(rnd, "spam" if k % 15 == 0 else "prose").translate(other), "en" if k == 1 else "xx") for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.flagged for r in flag_pages(docs).collect()}
    assert {k for k in got if k >= 10_000 and got[k]} == {10_000, 10_015}


def test_low_perplexity(spark):
    """One function-word phrase over and over is far more regular than sentences: the low bound."""
    rnd = random.Random(6)
    rows = [(k, " ".join(f"{sentence(rnd)[:-1]} of {rnd.choice(NOUNS)}." for _ in range(15))) for k in range(400)]
    model_of = spark.createDataFrame(rows, "id long, text string").selectExpr("id", "'' AS lang", "text")
    coded = model_of.mapInArrow(coder, "id long, lang string, hashes binary, codes binary")
    model = train_on(coded)
    low, high = model.low[0], model.high[0]
    assert 0 < low < high < 12
    part = features([" of the" * 40])
    best, _, pair = model.read(part)
    model.bits[pair] = low / 2
    assert model.score([" of the" * 40])[1][0] == 1.0


def test_prose_edge_cases(spark):
    rnd = random.Random(3)
    rows = [(k, page(rnd, "spam" if k % 12 == 0 else "prose")) for k in range(300)]
    rows += [(1000, None), (None, "x"), (1001, ""), (1002, "..."), (1003, "word"), (1, rows[1][1]), (1004, "x y " * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in flag_pages(docs).collect()}
    assert 1000 not in got and None not in got and len(got) == 304 and not got[1001].flagged and got[1001].n_words == 0 and got[1004].n_words == 60_000
    assert flag_pages(docs.where("doc_id < 0")).count() == 0
    bare = spark.createDataFrame([(1, "no sentence here", 7)], "doc_id long, text string, lang int")
    assert [(r.out_share, r.flagged) for r in flag_pages(bare).collect()] == [(0.0, False)]
