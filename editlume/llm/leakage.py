"""Evaluation items found in corpus texts, by the q-gram lemma in diagonal bands and banded alignment.

A text is reduced to its words joined by blanks. A passage that text and item have in common puts
all q-grams it holds on one diagonal (text offset minus item offset). So

1. q-grams of each text are looked up in an index of the items' q-grams, and hits are counted in
   diagonal bands that overlap by half;
2. a band is kept if it has at least as many hits as the poorest passage of `run` words of that
   item must leave (the q-gram lemma with its edit budget; see `ItemIndex`), and verified by an
   alignment confined to the band: the edit distance to the item must fit the budget that a shared
   passage leaves;
3. whole-text hits, by item position, meet the same kind of bound for half of the item's distinct
   word sequences, which may lie on any number of diagonals;
4. what is left is decided exactly, word by word.

Bounds are computed per item over the q-grams actually indexed, so no step loses a case. q-grams
that many items share are left out of the index where the bounds stay positive without them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editlume.llm.textnum import Batch, U, Words, pieces, qgrams, shingles, to_batch, word_text, words
from editlume.session import ship_package

Q = 10
BAND = 32
#: Which q-grams of an item are indexed: those in at most so many items, if the item's bounds are then
#: at least so high; else the next line. Any line gives the same results.
ATTEMPTS = ((2, 12), (4, 12), (8, 12), (16, 12), (1 << 40, 1))
_FILTER_BITS = 22
_NEVER = np.int64(1) << 40
_ITEM = (1 << 20) - 1
MAX_ITEMS = 100_000  # in a block
_SHIFT = 1 << 26


def _reduce(texts: list[str]) -> tuple[Batch, Words]:
    b = to_batch(texts, compose=True, drop_format=True)
    w = words(b)
    return word_text(b, w), w


@dataclass
class ItemIndex:
    """What the workers need of a block of items. Sizes are in proportion to the block's characters."""

    ids: np.ndarray
    text: Batch
    grams: np.ndarray = field(default_factory=lambda: np.zeros(0, U))  # sorted
    item: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    pos: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    run_hits: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # least hits of a shared run
    run_chars: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # least characters of it
    half_hits: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # least positions of half the sequences
    sets: list[np.ndarray] = field(default_factory=list)
    runs: list[np.ndarray] = field(default_factory=list)
    known: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))
    short_hash: np.ndarray = field(default_factory=lambda: np.zeros(0, U))  # word sequences of items too short for any bound, sorted
    short_item: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))


def build_index(ids: list[int], texts: list[str], run: int, shingle: int, share: float, q: int = Q) -> ItemIndex:
    text, w = _reduce(texts)
    n = len(ids)
    h, off = qgrams(text, q)
    owner = np.searchsorted(text.start, off, side="right") - 1
    pos = off - text.start[owner]
    # in how many items each q-gram occurs
    order = np.lexsort((owner, h))
    hs, os_ = h[order], owner[order]
    new = np.ones(len(hs), dtype=bool)
    new[1:] = hs[1:] != hs[:-1]
    group = np.cumsum(new) - 1
    new_owner = new.copy()
    new_owner[1:] |= os_[1:] != os_[:-1]
    spread = np.bincount(group, weights=new_owner, minlength=0)
    in_items = np.zeros(len(h), dtype=np.int64)
    in_items[order] = spread[group] if len(hs) else 0
    out = ItemIndex(np.asarray(ids, dtype=np.int64), text)
    run_hits, run_chars, half_hits = (np.full(n, _NEVER) for _ in range(3))
    use = np.zeros(len(h), dtype=bool)
    unfiltered = []
    wb = words(text)  # words of the reduced text: same words, offsets in it
    s_hash, s_doc, s_pos = shingles(wb, shingle)
    r_hash, r_doc, _ = shingles(wb, run)
    edges = np.arange(n + 1)
    o_at, s_at, r_at = (np.searchsorted(x, edges) for x in (owner, s_doc, r_doc))  # all three ascend
    for i in range(n):
        mine = np.arange(o_at[i], o_at[i + 1])
        a, b = wb.first[i], wb.first[i + 1]
        begin, end = wb.begin[a:b] - text.start[i], wb.end[a:b] - text.start[i]
        which = slice(s_at[i], s_at[i + 1])
        seq, first = np.unique(s_hash[which], return_index=True)
        out.sets.append(seq)
        out.runs.append(np.unique(r_hash[r_at[i] : r_at[i + 1]]))
        if not len(seq):
            continue
        starts = s_pos[which][first] - a
        need = int(np.ceil(share * len(seq) - 1e-9))
        for most, least in ATTEMPTS:
            attempt = in_items[mine] <= most
            held = np.zeros(text.start[i + 1] - text.start[i] + 1, dtype=np.int64)
            held[pos[mine][attempt] + 1] = 1
            held = np.cumsum(held)  # held[p]: indexed q-grams that begin before p
            inside = lambda lo, hi: np.maximum(held[np.maximum(hi - q + 1, lo)] - held[lo], 0)
            if len(begin) >= run:
                lo, hi = begin[: len(begin) - run + 1], end[run - 1 :]
                run_hits[i], run_chars[i] = inside(lo, hi).min(), (hi - lo).min()
            per_seq = np.sort(inside(begin[starts], end[starts + shingle - 1]))
            # a position lies in at most `shingle` consecutive sequences
            half_hits[i] = -(-per_seq[:need].sum() // shingle)
            if run_hits[i] >= least and half_hits[i] >= min(least, 4):
                use[mine] |= attempt
                break
        else:
            unfiltered.append(i)
            run_hits[i] = half_hits[i] = _NEVER
    by = np.argsort(h[use], kind="stable")
    out.grams, out.item, out.pos = h[use][by], owner[use][by], pos[use][by]
    out.run_hits, out.run_chars, out.half_hits = run_hits, run_chars, half_hits
    out.known = np.zeros(1 << _FILTER_BITS, dtype=bool)
    out.known[(out.grams & U((1 << _FILTER_BITS) - 1)).astype(np.int64)] = True
    if unfiltered:
        short = np.concatenate([out.sets[i] for i in unfiltered])
        by = np.argsort(short, kind="stable")
        out.short_hash, out.short_item = short[by], np.repeat(unfiltered, [len(out.sets[i]) for i in unfiltered])[by]
    return out


def short_pairs(index: ItemIndex, w: Words, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, item) of the short items of which a text has a word sequence, as each case must."""
    if not len(index.short_hash):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h, doc, _ = shingles(w, shingle)
    lo, hi = (np.searchsorted(index.short_hash, h, side=side) for side in ("left", "right"))
    some = np.flatnonzero(hi > lo)
    lo, size = lo[some], (hi - lo)[some]
    at = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
    pair = np.unique((np.repeat(doc[some], size) << 20) | index.short_item[at])
    return pair >> 20, pair & _ITEM


def hits(index: ItemIndex, text: Batch, q: int = Q) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, text offset, item, item offset) of every q-gram that a text and an item share."""
    h, off = qgrams(text, q)
    maybe = np.flatnonzero(index.known[(h & U((1 << _FILTER_BITS) - 1)).astype(np.int64)])
    h, off = h[maybe], off[maybe]
    lo = np.searchsorted(index.grams, h, side="left")
    hi = np.searchsorted(index.grams, h, side="right")
    size = hi - lo
    some = np.flatnonzero(size)
    lo, size, off = lo[some], size[some], off[some]
    at = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
    off = np.repeat(off, size)
    doc = np.searchsorted(text.start, off, side="right") - 1
    return doc, off - text.start[doc], index.item[at], index.pos[at]


def _runs(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct key begins, and how often it occurs."""
    new = np.ones(len(sorted_keys), dtype=bool)
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    at = np.flatnonzero(new)
    return at, np.diff(np.append(at, len(sorted_keys)))


def banded_distance(item: Batch, i: np.ndarray, text: Batch, d: np.ndarray, low: np.ndarray, width: int) -> np.ndarray:
    """Edit distance of item i[r] to the best region of text d[r] within diagonals low[r] .. low[r] + width - 1.

    The region may begin and end anywhere in the text; parts of the item before and after it cost one
    each character. All regions advance together, one item character a step.
    """
    n = item.start[i + 1] - item.start[i]
    size = text.start[d + 1] - text.start[d]
    best = n.astype(np.int32)
    if not len(i):
        return best
    cols = np.arange(width, dtype=np.int32)
    cost = np.zeros((len(i), width), dtype=np.int32)
    for k in range(int(n.max())):
        live = np.flatnonzero(n > k)
        if len(live) < len(cost):  # finished ones leave
            sel = np.flatnonzero(n[rows] > k) if k else live
            rows, cost = (rows[sel], cost[sel]) if k else (live, cost[live])
        elif k == 0:
            rows = live
        p = k + low[rows][:, None] + cols
        ok = (p >= 0) & (p < size[rows][:, None])
        c = np.where(ok, text.chars[np.minimum(np.where(ok, p, 0) + text.start[d[rows]][:, None], len(text.chars) - 1)], 0)
        step = cost + (c != item.chars[item.start[i[rows]] + k][:, None])
        step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
        step = np.minimum(step, k + 1)
        cost = (np.minimum.accumulate(step - cols, axis=1) + cols).astype(np.int32)
        best[rows] = np.minimum(best[rows], cost.min(axis=1) + (n[rows] - k - 1))
    return best


def _candidates(index: ItemIndex, text: Batch, w: Words, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, item, edit distance or -1) of the pairs that pass the bounds."""
    doc, at, item, pos = hits(index, text)
    # half a band per key: text (10 bits), item (20 bits), half band (24 bits)
    half = BAND // 2
    pair = (doc << 20) | item
    keys = np.sort((pair << 24) | ((at - pos + _SHIFT) // half))
    first, n = _runs(keys)
    keys = keys[first]
    follows = np.zeros(len(keys), dtype=np.int64)
    follows[:-1] = np.where(keys[1:] == keys[:-1] + 1, n[1:], 0)
    kept = keys[n + follows >= index.run_hits[(keys >> 24) & _ITEM]]
    bd, bi, low = kept >> 44, (kept >> 24) & _ITEM, (kept & 0xFFFFFF) * half - _SHIFT
    dist = banded_distance(index.text, bi, text, bd, low, BAND)
    chars = index.text.start[bi + 1] - index.text.start[bi]
    ok = dist <= chars - index.run_chars[bi]
    # whole-text hits by item position, first with repetitions, then without
    pk, start = np.unique(keys >> 24, return_index=True)
    total = np.add.reduceat(n, start) if len(pk) else np.zeros(0, np.int64)
    pk = pk[total >= index.half_hits[pk & _ITEM]]
    some = np.isin(pair, pk)
    distinct = np.unique((pair[some] << 24) | pos[some]) >> 24
    first, m = _runs(distinct)
    pk = distinct[first]
    pk = pk[m >= index.half_hits[pk & _ITEM]]
    hd, hi = pk >> 20, pk & _ITEM
    sd, si = short_pairs(index, w, shingle)
    all_d, all_i = np.concatenate((bd[ok], hd, sd)), np.concatenate((bi[ok], hi, si))
    all_e = np.concatenate((dist[ok], np.full(len(hd) + len(sd), -1)))
    order = np.lexsort((np.where(all_e < 0, 1 << 30, all_e), all_i, all_d))
    all_d, all_i, all_e = all_d[order], all_i[order], all_e[order]
    first = np.ones(len(all_d), dtype=bool)
    first[1:] = (all_d[1:] != all_d[:-1]) | (all_i[1:] != all_i[:-1])
    return all_d[first], all_i[first], all_e[first]


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    run: int = 12,
    shingle: int = 3,
    share: float = 0.5,
    block_chars: int = 2_000_000,
    blocks_a_pass: int = 4,
) -> DataFrame:
    """(doc_id, item_id, has_run, shared, edits): every text that contains an item, whole or in part.

    A case has at least `run` consecutive words of the item in a row, or at least `share` of the
    item's distinct sequences of `shingle` words. Words: maximal runs of letters and digits after
    NFKC, without category Cf, letter case ignored. shared: that share; edits: the characters of
    the best alignment found in a kept band, NULL if none was kept.

    Items are the stated query set: they are taken in blocks of `block_chars` characters, each sent
    to the workers once (some 50 MB a block). A pass over the corpus, in which every text is read
    and normalised once, serves `blocks_a_pass` of them. Items of fewer than `shingle`
    words, NULL ids and NULL texts are never found; rows repeated under one id count once (with
    differing texts, any of them may make the case). Extra columns are ignored.
    """
    spark = docs.sparkSession
    ship_package(spark)
    schema = f"{doc_id} long, {item_id} long, has_run boolean, shared double, edits int"
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).where("id is not null and text is not null")
    known = items.select(F.col(item_id).cast("long").alias("id"), F.col(text).alias("text")).where("id is not null and text is not null").distinct()
    found: DataFrame | None = None

    def search(blocks: list[list]) -> DataFrame:
        indexes = [spark.sparkContext.broadcast(build_index([r["id"] for r in b], [r["text"] for r in b], run, shingle, share)) for b in blocks]

        def look_up(x: ItemIndex, piece: pa.RecordBatch, texts: list[str], reduced: Batch, words_: Words) -> pa.RecordBatch | None:
            d, i, e = _candidates(x, reduced, words_, shingle)
            if not len(d):
                return None
            chosen, place = np.unique(d, return_inverse=True)
            _, w = _reduce([texts[k] for k in chosen])
            sh, sd, _ = shingles(w, shingle)
            rh, rd, _ = shingles(w, run)
            sb = np.searchsorted(sd, np.arange(len(chosen) + 1))
            rb = np.searchsorted(rd, np.arange(len(chosen) + 1))
            shared = np.array([np.isin(x.sets[b], sh[sb[a] : sb[a + 1]]).sum() / max(1, len(x.sets[b])) for a, b in zip(place, i)])
            has_run = np.array([np.isin(x.runs[b], rh[rb[a] : rb[a + 1]]).any() for a, b in zip(place, i)], dtype=bool)
            ok = has_run | (shared >= share - 1e-12)
            ids = piece.column(0).take(pa.array(d[ok]))
            edits = pa.array(e[ok].astype(np.int32), mask=e[ok] < 0)
            return pa.RecordBatch.from_arrays([ids, pa.array(x.ids[i[ok]]), pa.array(has_run[ok]), pa.array(shared[ok]), edits], names=[doc_id, item_id, "has_run", "shared", "edits"])

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in pieces(batch, 1):
                    texts = piece.column(1).to_pylist()
                    reduced, w = _reduce(texts)  # once for all blocks
                    for index in indexes:
                        if (got := look_up(index.value, piece, texts, reduced, w)) is not None:
                            yield got

        return rows.mapInArrow(work, schema)

    blocks: list[list] = [[]]
    size = 0
    for r in known.toLocalIterator():
        if size >= block_chars or len(blocks[-1]) >= MAX_ITEMS:
            if len(blocks) == blocks_a_pass:
                part = search(blocks)
                found = part if found is None else found.unionByName(part)
                blocks = []
            blocks.append([])
            size = 0
        blocks[-1].append(r)
        size += len(r["text"])
    part = search(blocks)
    found = part if found is None else found.unionByName(part)
    return found.groupBy(doc_id, item_id).agg(F.max("has_run").alias("has_run"), F.max("shared").alias("shared"), F.min("edits").alias("edits"))
