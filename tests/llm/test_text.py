"""Text vectors and the Golay code against plain Python."""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from editlume.llm import golay
from editlume.llm import textnum as T

WORD = re.compile(r"[^\W_]+")
ALPHABET = st.text(st.sampled_from("aAbz09_ .,\n-éßİ½²Ã́\xad日本\U00010330"), max_size=40)


@settings(max_examples=150, deadline=None)
@given(st.lists(ALPHABET, min_size=1, max_size=6))
def test_words_shingles_qgrams(texts):
    b = T.to_batch(texts)
    w = T.words(b)
    want = [WORD.findall(t.lower()) for t in texts]
    got = [["".join(map(chr, b.chars[p:q])) for p, q in zip(w.begin[w.first[i] : w.first[i + 1]], w.end[w.first[i] : w.first[i + 1]])] for i in range(len(texts))]
    assert got == want
    flat = [x for t in want for x in t]
    pairs = {}
    assert all(pairs.setdefault(int(h), x) == x for h, x in zip(w.hash, flat)) and len(pairs) == len(set(flat))
    h, d, _ = T.shingles(w, 2)
    assert list(zip(d.tolist(), [None] * len(d))) == [(i, None) for i, t in enumerate(want) for _ in t[1:]]
    assert len(set(h.tolist())) == len({(x, y) for t in want for x, y in zip(t, t[1:])})
    c = T.word_text(b, w)
    texts2 = ["".join(map(chr, c.chars[c.start[i] : c.start[i + 1]])) for i in range(len(texts))]
    assert texts2 == [" " + "".join(x + " " for x in t) for t in want]
    h, off = T.qgrams(c, 3)
    grams = [t[k : k + 3] for t in texts2 for k in range(len(t) - 2)]
    assert len(off) == len(grams) and len(set(h.tolist())) == len(set(grams))


def test_composition_and_format_characters():
    b = T.to_batch(["Ca\xadfé ﬁne", "½"], compose=True, drop_format=True)
    w = T.words(b)
    assert ["".join(map(chr, b.chars[p:q])) for p, q in zip(w.begin, w.end)] == WORD.findall(unicodedata.normalize("NFKC", "café ﬁne ½").lower())


def test_pieces_bound_characters():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 10, None, "b" * 100, "c", ""])], names=["t"])
    assert [p.num_rows for p in T.pieces(batch, 0, 10, 50)] == [2, 1, 2]
    assert [p.num_rows for p in T.pieces(batch, 0, 2, 1000)] == [2, 2, 1]


def test_golay_promise():
    rng = np.random.default_rng(1)
    w = rng.integers(0, 1 << 23, 3000)
    a = golay.indices(w)
    assert set((a >= 0).sum(axis=1).tolist()) == {1, 6} and a.max() < 4096
    for flips in (0, 1, 2):
        v = w.copy()
        for k in range(len(v)):
            for bit in rng.choice(23, flips, replace=False):
                v[k] ^= 1 << int(bit)
        b = golay.indices(v)
        assert all(set(x[x >= 0].tolist()) & set(y[y >= 0].tolist()) for x, y in zip(a, b))
