"""Words, shingles and character q-grams of whole batches of texts as numpy arrays.

A batch is one array of code points; every step is a few vector operations over it, so the cost
per character does not depend on how the texts are cut into rows.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_BASE = U(0x9E3779B97F4A7C15)
_BASE_INV = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@lru_cache(maxsize=1)
def _alnum_table() -> np.ndarray:
    return np.fromiter(map(str.isalnum, map(chr, range(sys.maxunicode + 1))), dtype=bool, count=sys.maxunicode + 1)


@lru_cache(maxsize=1)
def _format_table() -> np.ndarray:
    return np.fromiter((unicodedata.category(chr(i)) == "Cf" for i in range(sys.maxunicode + 1)), dtype=bool, count=sys.maxunicode + 1)


@lru_cache(maxsize=1)
def _char_values() -> np.ndarray:
    return mix(np.arange(1, sys.maxunicode + 2, dtype=U))


_powers: dict[str, np.ndarray] = {}


def _power(base: U, name: str, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        steps = np.full(size, base, dtype=U)
        steps[0] = U(1)
        have = _powers[name] = np.cumprod(steps, dtype=U)
    return have[:n]


@dataclass
class Batch:
    """code points of all texts in a row; text i is chars[start[i]:start[i + 1]]."""

    chars: np.ndarray
    start: np.ndarray


def normalize_nfkc(text: str) -> str:
    if text.isascii() or unicodedata.is_normalized("NFKC", text):
        return text
    return unicodedata.normalize("NFKC", text)


def to_batch(texts: Sequence[str], compose: bool = False, drop_format: bool = False) -> Batch:
    """Lower-case texts as code points; `compose`: NFKC first; `drop_format`: without category Cf."""
    low = [(normalize_nfkc(t) if compose else t).lower() for t in texts]
    chars = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    start = np.zeros(len(low) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in low], out=start[1:])
    if drop_format and len(chars):
        keep = ~_format_table()[chars]
        if not keep.all():
            before = np.zeros(len(chars) + 1, dtype=np.int64)
            np.cumsum(keep, out=before[1:])
            chars, start = chars[keep], before[start]
    return Batch(chars, start)


@dataclass
class Words:
    """Word k of the batch is chars[begin[k]:end[k]] and belongs to text `doc[k]`; text i has words first[i]:first[i+1]."""

    begin: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    hash: np.ndarray


def words(b: Batch) -> Words:
    """Maximal runs of Unicode letters and digits, none reaching over the end of its text, with 64-bit hashes."""
    n = len(b.chars)
    inside = np.zeros(n + 1, dtype=bool)
    inside[:n] = _alnum_table()[b.chars]
    opens = inside[:n].copy()
    opens[1:] &= ~inside[: n - 1]
    cut = b.start[1:-1]
    cut = cut[cut < n]
    opens[cut] = inside[cut]  # a new text starts a new word
    begin = np.flatnonzero(opens)
    closes = inside[:n].copy()
    closes &= ~inside[1:]
    last = cut[cut > 0] - 1
    closes[last] = inside[last]
    end = np.flatnonzero(closes) + 1
    value = np.where(inside[:n], _char_values()[b.chars], U(0))
    total = np.zeros(n + 1, dtype=U)
    np.cumsum(value * _power(_BASE, "p", n), dtype=U, out=total[1:])
    h = (total[end] - total[begin]) * _power(_BASE_INV, "i", n + 1)[begin]
    doc = np.searchsorted(b.start, begin, side="right") - 1
    first = np.searchsorted(begin, b.start, side="left")
    return Words(begin, end, doc, first, mix(h ^ (end - begin).astype(U)))


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, position of the first word) of all runs of `size` words."""
    n = len(w.hash) - size + 1
    if n <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    pos = np.flatnonzero(w.doc[:n] == w.doc[size - 1 :])
    h = np.zeros(len(pos), dtype=U)
    for k in range(size):
        h = mix(h * U(0x2545F4914F6CDD1D) + w.hash[pos + k])
    return h, w.doc[pos], pos


def word_text(b: Batch, w: Words) -> Batch:
    """The words of each text joined by single blanks, with one blank before and after."""
    k = len(w.begin)
    size = w.end - w.begin
    n_texts = len(b.start) - 1
    # each word is followed by one blank, each text is opened by one
    out_len = np.bincount(w.doc, weights=size + 1, minlength=n_texts).astype(np.int64) + 1
    start = np.zeros(n_texts + 1, dtype=np.int64)
    np.cumsum(out_len, out=start[1:])
    chars = np.full(start[-1], 32, dtype=np.uint32)
    if k:
        before = np.zeros(k, dtype=np.int64)
        np.cumsum(size[:-1] + 1, out=before[1:])
        at = before + w.doc + 1  # one opening blank per text up to and including this one; empty texts have one too
        src = np.repeat(w.begin - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
        dst = np.repeat(at - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
        chars[dst] = b.chars[src]
    return Batch(chars, start)


def qgrams(b: Batch, q: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, offset) of every run of q characters that lies within one text."""
    n = len(b.chars)
    if n < q:
        return np.zeros(0, U), np.zeros(0, np.int64)
    total = np.zeros(n + 1, dtype=U)
    np.cumsum(_char_values()[b.chars] * _power(_BASE, "p", n), dtype=U, out=total[1:])
    h = mix((total[q:] - total[:-q]) * _power(_BASE_INV, "i", n + 1)[: n - q + 1])
    ok = np.ones(n - q + 1, dtype=bool)
    for e in range(1, q):  # runs that would reach over the end of a text
        at = b.start[1:-1] - e
        ok[at[(at >= 0) & (at <= n - q)]] = False
    off = np.flatnonzero(ok)
    return h[off], off


def pieces(batch: pa.RecordBatch, column: int = 0, max_rows: int = 1000, max_chars: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of at most `max_rows` rows and about `max_chars` characters of text: bounds the arrays made from one slice."""
    sizes = pc.fill_null(pc.utf8_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.concatenate(([0], np.cumsum(sizes)))
    at = 0
    while at < batch.num_rows:
        upto = int(np.searchsorted(total, total[at] + max_chars, side="right")) - 1
        upto = min(max(upto, at + 1), at + max_rows, batch.num_rows)
        yield batch.slice(at, upto - at)
        at = upto
