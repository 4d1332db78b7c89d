"""Near-duplicate texts by Golay-code fuzzy hashing.

Fingerprint. A text has `SLOTS` segments. A segment has two parts. The anchor is the word sequence
with the least value under the slot's own random order, among the text's rarer sequences; it must
agree exactly. The field is a 23-bit word with a bit for each of the six words around the anchor: an
edit of one of them changes two bits at most. Decoding the field to the nearby code words of the
Golay code gives one or six indices; two fields up to two bits apart have one in common. So a segment
is free of error if the anchor agrees and the field differs by no more than one edited word, and by
the pigeonhole two texts meet if one of their segments is. Pairs that meet are compared: by sizes and
set parities (which drop none that can reach the threshold), folded to 128 bits where they meet and
whole after that, then on the whole sets.

Shuffle. A segment is one row, shuffled by its anchor; the task that has an anchor's texts decodes
their fields and compares them (`FEW` texts or less without decoding, which gives the same pairs).
Only anchors that may have more texts than a task holds, by the corpus count of their sequence
(`LOCAL_LEVEL`), are decoded first and shuffled by anchor and index.

Parts. Classes are folded by their hashes, segments dealt by their anchors, and prefixes by their
members, in up to `PARTS` parts. One part after another is shuffled, and only the pairs left over by the
folded parities are kept: pairs that meet by chance grow faster than the input, and never stand on disk.

Rarer sequences. Sequences are ordered by how often the corpus has them (`count_sketch`), and a
text's anchors come from the `RARE` first of its own. Two sets that share the part t of their union
share at least RARE + t - 1 of the larger set's members within these, whatever the order, so the
anchors of two similar texts agree often, while stock phrases are anchors only of texts made of
little else. Sequences found once in the corpus are no text's anchor.

Crowded keys. A key (slot, anchor, index) of more than `CROWD` texts is not compared pair by pair;
all texts with such a key meet by prefixes of their sets instead, which loses none of their pairs:
sets that share `threshold` of their union have a member in common among the
n - ceil(threshold n) + 1 first members of either, in that same order.

Equal texts are folded to one class before anything else. The README has the measured share of
pairs missed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from editlume.llm import golay
from editlume.llm.textnum import U, mix, pieces, shingles, to_batch, words
from editlume.session import drop_materialized, materialize, ship_package, transient_shuffles

SLOTS = 16
CONTEXT = 3
RARE = 0.7
CROWD = 128
FEW = 32
#: Sequences the corpus has less often than 2 ** (LOCAL_LEVEL / 2) times: the texts with such an anchor fit into a task.
LOCAL_LEVEL = 32
#: Segments or prefix members in a part, until there are PARTS of them; classes are folded in as many.
PART_ROWS = 4_000_000
PARTS = 6
#: Counters of the sketch, as a power of two: from the size of the input within these. Fewer make the order of
#: sequences coarser, and so crowd more keys; results stay.
SKETCH_BITS = (22, 26)
#: Up to so many ids are looked up in a bit map of 8 to 16 bits an id (16 MB at most); more are joined.
FILTER_IDS = 1 << 23
PARITY_LONGS = 8
PARITY = [f"p{k}" for k in range(PARITY_LONGS)]
FOLD_LONGS = 2
FOLD = [f"q{k}" for k in range(FOLD_LONGS)]  # the parities with their longs added up: fits beside each key
_BLOCK_BITS = 14
_LEVEL, _HASH = 6, 48  # bits of a sequence's place in the order: level of its count, then hash
_FIELD = (1 << golay.N_BITS) - 1
_WIDE = 1 << golay.N_BITS  # beside a field: its anchor is of LOCAL_LEVEL or more
_SIZE = golay.N_BITS + 1  # where the set size begins beside field and mark


def _merged_table(rows: DataFrame, bits: int, values: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """Counts of the hashes that `values` makes of all rows, as levels 0 to 63 (`_levels`), in a table of 2**bits bytes.

    Every task adds up its own table and sends it on in blocks; blocks are added up by partition,
    one at a time, and only the finished table comes to the driver.
    """
    block_bits = min(_BLOCK_BITS, bits)
    width = 1 << block_bits

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, dtype=np.int32)
        for batch in batches:
            for piece in pieces(batch) if pa.types.is_string(batch.schema.field(0).type) else [batch]:
                seen, n = np.unique((values(piece) & U((1 << bits) - 1)).astype(np.uint32), return_counts=True)
                counts[seen] = np.minimum(counts[seen] + n, 2**31 - 1)
        for block in range(len(counts) // width):
            part = counts[block * width : (block + 1) * width]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["block", "counts"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(raw.as_buffer(), dtype=np.int32)
                sums[block] = sums[block] + part if block in sums else part.astype(np.int64)
        for block, counts in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([_levels(counts).tobytes()], pa.binary())], names=["block", "counts"])

    schema = "block int, counts binary"
    with transient_shuffles(rows.sparkSession):
        merged = rows.mapInArrow(local, schema).repartition("block").mapInArrow(merge, schema).collect()
    out = np.zeros((1 << (bits - block_bits), width), dtype=np.uint8)
    for row in merged:
        out[row["block"]] = np.frombuffer(bytes(row["counts"]), dtype=np.uint8)
    return out.reshape(-1)


def _levels(counts: np.ndarray) -> np.ndarray:
    """0 for no more than one, then two levels for each doubling."""
    return np.minimum(np.floor(2 * np.log2(np.maximum(counts, 1))), (1 << _LEVEL) - 1).astype(np.uint8)


def count_sketch(texts: DataFrame, shingle: int, bits: int) -> np.ndarray:
    """Levels of the counts of all word sequences of `texts` (text, ...), by hash; a count may be too high, never too low."""

    def values(piece: pa.RecordBatch) -> np.ndarray:
        return shingles(words(to_batch(piece.column(0).to_pylist())), shingle)[0] >> U(16)

    return _merged_table(texts, bits, values)


def id_filter(ids: DataFrame, n: int) -> np.ndarray:
    """A bit map that holds every id of the one column of `ids` (n rows) and one in eight or less of all others."""
    bits = max(12, int(max(n, 1) - 1).bit_length() + 3)
    # counted as often as twice, so that the level is above zero
    found = _merged_table(ids, bits, lambda batch: np.repeat(mix(batch.column(0).to_numpy().view(U)), 2))
    return np.packbits(found > 0, bitorder="little")


def _passing(ids: np.ndarray, bits: np.ndarray) -> np.ndarray:
    at = mix(ids.view(U)) & U(8 * len(bits) - 1)
    return bits[(at >> U(3)).astype(np.int64)] >> (at & U(7)).astype(np.uint8) & 1 > 0


def _passing_rows(batch: pa.RecordBatch, wanted: Broadcast | None) -> pa.RecordBatch:
    return batch if wanted is None else batch.filter(pa.array(_passing(batch.column(0).to_numpy(), wanted.value)))


def only(rows: DataFrame, ids: DataFrame) -> tuple[DataFrame, Broadcast | None]:
    """The rows (id, ...) of `ids` (a table with the one column id): a bit map to look these up in, or, of many ids, the joined rows.

    The bit map spares the shuffle of texts; an id it lets through wrongly finds no pair later.
    """
    n = ids.count()
    if n > FILTER_IDS:
        return rows.join(ids.distinct(), "id", "left_semi").select(*rows.columns), None
    return rows, rows.sparkSession.sparkContext.broadcast(id_filter(ids, n))


def _ordered(h: np.ndarray, doc: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in the order of each sequence; the distinct places of all texts, ascending text by text; the text of each of these).

    Text number (below 1024: a slice has at most 1000 rows) and place share one word, as sorting one array is much faster.
    """
    level = sketch[(h >> U(16) & U(len(sketch) - 1)).astype(np.int64)].astype(U)
    place = level << U(_HASH) | h >> U(16)
    packed = np.sort(doc.astype(U) << U(54) | place)
    new = np.ones(len(packed), dtype=bool)
    new[1:] = packed[1:] != packed[:-1]
    packed = packed[new]
    return place, packed & U((1 << 54) - 1), (packed >> U(54)).astype(np.int64)


def _segments(texts: list[str], shingle: int, min_words: int, sketch: np.ndarray, local: int) -> tuple[np.ndarray, ...]:
    """(row, class hash 1, class hash 2, anchors, fields, set size, parities) of the texts with enough words; anchor 0: none.

    A field has the mark `_WIDE` if its anchor is of level `local` or more.
    """
    w = words(to_batch(texts))
    h, doc, pos = shingles(w, shingle)
    n_words = np.diff(w.first)
    enough = n_words >= max(min_words, shingle)
    rows = np.flatnonzero(enough)
    keep = enough[doc]
    h, doc, pos = h[keep], doc[keep], pos[keep]
    if not len(rows):
        e = np.zeros(0, dtype=np.int64)
        return rows, e, e, e.reshape(0, SLOTS), e.reshape(0, SLOTS), e, e.reshape(0, PARITY_LONGS)
    first = np.searchsorted(doc, rows, side="left")
    nth = (np.arange(len(h)) - np.repeat(first, np.diff(np.append(first, len(doc))))).astype(U)
    c1 = np.add.reduceat(mix(h ^ mix(nth)), first)
    c2 = np.add.reduceat(mix(h + mix(nth + U(0x5851F42D4C957F2D))), first)
    place, distinct, owner = _ordered(h, doc, sketch)
    n = np.bincount(owner, minlength=len(texts))
    bits = PARITY_LONGS * 64
    odd = np.bincount(owner * bits + (distinct % U(bits)).astype(np.int64), minlength=len(texts) * bits).astype(np.uint8) & 1
    parity = np.packbits(odd.reshape(len(texts), bits), axis=1).view(np.int64)
    last = np.cumsum(n) - n + np.ceil(RARE * n - 1e-9).astype(np.int64) - 1  # of the rarer ones
    rare = np.flatnonzero((place <= distinct[np.maximum(last, 0)][doc]) & (place >= U(1 << _HASH)))
    anchors = np.zeros((len(rows), SLOTS), dtype=U)
    fields = np.zeros((len(rows), SLOTS), dtype=np.int64)
    if len(rare):
        h, doc, pos = h[rare], doc[rare], pos[rare]
        wide = np.where(place[rare] >> U(_HASH) >= U(local), _WIDE, 0)
        some = np.unique(doc)
        at_row = np.searchsorted(rows, some)
        first = np.searchsorted(doc, some, side="left")
        size = np.diff(np.append(first, len(doc)))
        lo, hi = w.first[some], w.first[some + 1]
        bit = np.left_shift(np.int64(1), (w.hash % U(golay.N_BITS)).astype(np.int64))
        for s in range(SLOTS):
            seed = mix(np.array([s + 1], dtype=U))[0]
            order = mix(h ^ seed)
            hits = np.flatnonzero(order == np.repeat(np.minimum.reduceat(order, first), size))
            at = hits[np.searchsorted(hits, first, side="left")]
            anchors[at_row, s] = mix(h[at] + seed) | U(1)
            field = wide[at]
            for o in (*range(-CONTEXT, 0), *range(shingle, shingle + CONTEXT)):
                p = pos[at] + o
                ok = (p >= lo) & (p < hi)
                field[ok] |= bit[p[ok]]
            fields[at_row, s] = field
    return rows, c1.view(np.int64), c2.view(np.int64), anchors.view(np.int64), fields, n[rows], parity[rows]


def fingerprints(rows: DataFrame, shingle: int, min_words: int, sketch: Broadcast) -> DataFrame:
    """(id, c1, c2, segments, n, p0, p1, ...) of each row (id, text) whose text has enough words; segments: anchors (8 bytes each), then fields (4)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 1):
                at, c1, c2, anchors, fields, n, parity = _segments(piece.column(1).to_pylist(), shingle, min_words, sketch.value, LOCAL_LEVEL)
                raw = np.concatenate((anchors.astype(np.int64).view(np.uint8).reshape(len(at), 8 * SLOTS), fields.astype(np.int32).view(np.uint8).reshape(len(at), 4 * SLOTS)), axis=1)
                segments = [x.tobytes() if a else None for x, a in zip(raw, anchors.any(axis=1))]
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0).take(pa.array(at)), pa.array(c1), pa.array(c2), pa.array(segments, pa.binary()), pa.array(n.astype(np.int32)),
                        *[pa.array(np.ascontiguousarray(parity[:, k])) for k in range(PARITY_LONGS)],
                    ],
                    names=["id", "c1", "c2", "segments", "n", *PARITY],
                )

    return rows.mapInArrow(run, "id long, c1 long, c2 long, segments binary, n int, " + ", ".join(f"{p} long" for p in PARITY))


def n_parts(rows: int) -> int:
    return min(max(-(-rows // PART_ROWS), 1), PARTS)


def segment_keys(classes: DataFrame, part: int, parts: int) -> DataFrame:
    """(key, f, rep, q0, q1, label) of the segments of the classes (rep, n, segments, parities, label) whose anchor is in the part; label if given.

    One row per segment, under its anchor, where the anchor's texts fit into a task, else one per code word
    index of its field, under a hash of both. f is set size, mark and field in one.
    """
    label = [c for c in classes.columns if c == "label"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=np.uint8).reshape(batch.num_rows, 12 * SLOTS)
            anchors = np.ascontiguousarray(raw[:, : 8 * SLOTS]).view(U).reshape(-1)
            fields = np.ascontiguousarray(raw[:, 8 * SLOTS :]).view(np.int32).reshape(-1).astype(np.int64)
            at = np.flatnonzero((anchors >> U(7)) % U(parts) == U(part))
            wide = at[fields[at] >= _WIDE]
            at = at[fields[at] < _WIDE]
            index = golay.indices(fields[wide] & _FIELD)
            row, col = np.nonzero(index >= 0)
            key = np.concatenate((anchors[at], mix(anchors[wide][row] ^ mix(index[row, col].astype(U) + U(1)))))
            at = np.concatenate((at, wide[row]))
            f = batch.column(1).to_numpy().astype(np.int64)[at // SLOTS] << _SIZE | fields[at]
            own = pa.array(at // SLOTS)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(f), *[c.take(own) for c in batch.columns[2:]]], names=["key", "f", "rep", *FOLD, *label])

    fold = [reduce(Column.bitwiseXOR, map(F.col, PARITY[k::FOLD_LONGS])).alias(q) for k, q in enumerate(FOLD)]
    rows = classes.where("segments is not null").select("segments", "n", "rep", *fold, *label)
    return rows.mapInArrow(run, "key long, f long, rep long, " + ", ".join(f"{q} long" for q in (*FOLD, *label)))


def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first row, rows) of the runs of equal keys."""
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    return first, np.diff(np.append(first, len(key)))


def _met(rows: list[np.ndarray], threshold: float, star: bool, few: int, crowd: int) -> tuple[np.ndarray, np.ndarray]:
    """(pairs, classes with a crowded key) of whole keys, rows (key, f, rep, q0, q1, label) by key and rep; `star`: each key's first class with the others."""
    first, size = _runs(rows[0])
    n = np.repeat(size, size)
    split = (n > few) & (rows[1] & _WIDE == 0)
    one, many = np.flatnonzero(~split & (n > 1)), np.flatnonzero(split)
    index = golay.indices(rows[1][many] & _FIELD)
    row, col = np.nonzero(index >= 0)
    bucket = np.repeat(np.arange(len(first)), size)[many][row] << 12 | index[row, col]
    order = np.argsort(bucket, kind="stable")
    at = np.concatenate((one, many[row[order]]))
    size = np.concatenate((_runs(rows[0][one])[1], _runs(bucket[order])[1]))
    crowded = np.zeros(0, dtype=np.int64)
    if not star:
        over = np.repeat(size > crowd, size)
        crowded = np.unique(rows[2][at[over]])
        at, size = at[~over], size[size <= crowd]
    f, rep, *rest = (c[at] for c in rows[1:])
    after = np.repeat(np.cumsum(size), size) - np.arange(len(at)) - 1  # rows of the same key that follow
    met = []

    def keep(i: np.ndarray, j: np.ndarray) -> None:
        na, nb = f[i] >> _SIZE, f[j] >> _SIZE
        ok = rep[i] != rep[j]
        if not star:
            ok &= np.minimum(na, nb) >= threshold * np.maximum(na, nb) - 1e-9
        differ = sum(np.bitwise_count((q[i] ^ q[j]).view(U)).astype(np.int64) for q in rest[:FOLD_LONGS])
        ok &= differ <= (na + nb) * ((1 - threshold) / (1 + threshold)) + 1e-9
        for label in rest[FOLD_LONGS:]:
            ok &= label[i] != label[j]
        met.append(np.stack((rep[i[ok]], rep[j[ok]]), axis=1))

    if star:
        centre = np.repeat(np.cumsum(size) - size, size)
        others = np.flatnonzero(centre != np.arange(len(at)))
        keep(centre[others], others)
    else:
        i, d = np.flatnonzero(after > 0), 1
        while len(i):
            near = i[np.bitwise_count((f[i] ^ f[i + d]) & _FIELD) <= golay.TOLERANCE]
            keep(near, near + d)
            d += 1
            i = i[after[i] >= d]
    return np.unique(np.concatenate([np.zeros((0, 2), dtype=np.int64), *met]), axis=0), crowded


def meeting(keys: DataFrame, threshold: float, star: bool = False) -> DataFrame:
    """Pairs (a, b), a < b, of classes with a key in common, fields within two bits, and sizes and parities that allow the threshold; of different labels, if there are.

    The texts of an anchor are in one task, which gives those of more than `FEW` their code word indices. b is
    NULL where a has a key of more than `CROWD` texts. `star`: the pairs of each key's least class instead,
    whatever the fields. A key that may be larger than memory is not held: its rows are all crowded, or all meet the first one.
    """
    names = keys.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in _ended(batches):
            rows = held
            if batch is not None:
                new = [c.to_numpy() for c in batch.columns]
                rows = [np.concatenate(x) for x in zip(held, new)] if held else new
            if not rows or not len(rows[0]):
                continue
            last = len(rows[0]) if batch is None else int(np.searchsorted(rows[0], rows[0][-1], side="left"))
            held = [c[last:] for c in rows]
            if batch is not None and len(held[0]) > CROWD and held[1][0] & _WIDE:
                last, held = len(rows[0]), [c[: 1 if star else CROWD + 1] for c in held]
            pairs, crowded = _met([c[:last] for c in rows], threshold, star, FEW, CROWD)
            none = np.concatenate((np.zeros(len(pairs), dtype=bool), np.ones(len(crowded), dtype=bool)))
            a = np.concatenate((pairs[:, 0], crowded))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(np.concatenate((pairs[:, 1], crowded)), mask=none)], names=["a", "b"])

    return keys.repartition("key").sortWithinPartitions("key", "rep").select(*names).mapInArrow(run, "a long, b long").distinct()


def _ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    """The batches, then None."""
    yield from batches
    yield None


def _may_reach(na: Column, nb: Column, threshold: float, parities: list[str], a: str = "a", b: str = "b") -> Column:
    """Whether the sets can share `threshold` of their union: they then differ in at most (1 - t) / (1 + t) of the sum of their sizes, and parities in no more bits."""
    differ = reduce(Column.__add__, [F.bit_count(F.col(p + a).bitwiseXOR(F.col(p + b))) for p in parities])
    return differ <= (na + nb) * ((1 - threshold) / (1 + threshold)) + 1e-9


def shingle_sets(rows: DataFrame, shingle: int, wanted: Broadcast | None) -> DataFrame:
    """(id, grams): the sorted distinct word sequences of each row (id, text) whose id is `wanted`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(1, dtype=np.uint8)
        for batch in batches:
            for piece in pieces(_passing_rows(batch, wanted), 1):
                h, doc, _ = shingles(words(to_batch(piece.column(1).to_pylist())), shingle)
                _, h, doc = _ordered(h, doc, none)
                offsets = np.searchsorted(doc, np.arange(piece.num_rows + 1), side="left").astype(np.int32)
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(h.view(np.int64)))], names=["id", "grams"])

    return rows.mapInArrow(run, "id long, grams array<long>")


def prefixes(rows: DataFrame, shingle: int, threshold: float, wanted: Broadcast | None, sketch: Broadcast) -> DataFrame:
    """(id, n, q0, q1, tokens, places) of each row (id, text) whose id is `wanted`.

    n is the size of its set, q0 and q1 its folded parities, tokens 32 bits of the members of its prefix, rarest first, and places their
    places in the order of the whole set. Members the sketch has counted once are no other text's and left out.
    """

    bits = FOLD_LONGS * 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(_passing_rows(batch, wanted), 1):
                h, doc, _ = shingles(words(to_batch(piece.column(1).to_pylist())), shingle)
                _, h, doc = _ordered(h, doc, sketch.value)
                n = np.bincount(doc, minlength=piece.num_rows)
                odd = np.bincount(doc * bits + (h % U(bits)).astype(np.int64), minlength=piece.num_rows * bits).astype(np.uint8) & 1
                fold = np.packbits(odd.reshape(piece.num_rows, bits), axis=1).view(np.int64)
                place = np.arange(len(h)) - (np.cumsum(n) - n)[doc]
                keep = (place <= (n - np.ceil(threshold * n - 1e-9))[doc]) & (h >= U(1 << _HASH))
                offsets = pa.array(np.searchsorted(doc[keep], np.arange(piece.num_rows + 1), side="left").astype(np.int32))
                tokens, places = pa.array(h[keep].astype(np.uint32).view(np.int32)), pa.array(place[keep].astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0), pa.array(n.astype(np.int32)), *[pa.array(np.ascontiguousarray(fold[:, k])) for k in range(FOLD_LONGS)],
                        pa.ListArray.from_arrays(offsets, tokens), pa.ListArray.from_arrays(offsets, places),
                    ],
                    names=["id", "n", *FOLD, "tokens", "places"],
                )

    return rows.mapInArrow(run, f"id long, n int, {', '.join(f'{q} long' for q in FOLD)}, tokens array<int>, places array<int>")


def crowd_pairs(crowd: "Prefixes", part: int, parts: int, label: DataFrame | None = None) -> DataFrame:
    """All pairs (a, b), a < b, of the crowd that can reach the threshold by the part of their prefixes' members; of different labels (rep, label), if given.

    The first member two prefixes have in common bounds what the sets share to what follows it. A
    common token that comes right after a common one makes no row: the one before has made it.
    With labels, tokens of one label meet nothing, and of the others only texts without the token's
    most frequent label are compared with all.
    """
    before = F.concat(F.array(F.lit(None).cast("int")), "tokens")
    texts, cols = crowd.texts, ["rep", "n", *FOLD, "places", "before"]
    if label is not None:
        texts, cols = texts.join(label, "rep", "left").withColumn("label", F.coalesce("label", "rep")), [*cols, "label"]
    own = [c for c in cols if c not in ("places", "before")]
    entries = texts.where("size(tokens) > 0").select(*own, F.inline(F.arrays_zip("tokens", "places", before.alias("before")))).where("tokens is not null")
    entries = entries.where(F.pmod("tokens", F.lit(parts)) == part)
    one = entries
    if label is not None:
        most = entries.groupBy("tokens", "label").agg(F.count("*").alias("_n")).groupBy("tokens").agg(F.max_by("label", F.struct("_n", "label")).alias("_most"), F.count("*").alias("_labels"))
        one = entries.join(most.where("_labels > 1"), "tokens").where("label <> _most")
    a = one.select("tokens", *[F.col(c).alias(c + "a") for c in cols])
    b = entries.select("tokens", *[F.col(c).alias(c + "b") for c in cols])
    rest = F.least(F.col("na") - F.col("placesa"), F.col("nb") - F.col("placesb"))
    enough = rest >= (F.col("na") + F.col("nb")) * (crowd.threshold / (1 + crowd.threshold)) - 1e-9
    first = F.coalesce(F.col("beforea") != F.col("beforeb"), F.lit(True))
    met = a.join(b, "tokens").where((F.col("repa") < F.col("repb") if label is None else F.col("labela") != F.col("labelb")) & enough & first & _may_reach(F.col("na"), F.col("nb"), crowd.threshold, FOLD))
    return met.select(F.least("repa", "repb").alias("a"), F.greatest("repa", "repb").alias("b")).distinct()


@dataclass
class Prefixes:
    """The prefixes (rep, n, q0, q1, tokens, places) of the classes with a crowded key."""

    texts: DataFrame
    threshold: float
    parts: int


@dataclass
class Meeting:
    """Where classes can meet: what pairs and groups are made of."""

    rows: DataFrame  # (id, text): id stands for one text only
    members: DataFrame  # (id, rep, n_copies)
    classes: list[DataFrame]  # by part, (rep, n, segments, parities)
    sketch: Broadcast
    shingle: int
    threshold: float

    def _classes(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.classes)

    def pairs(self, label: DataFrame | None = None) -> DataFrame:
        """A table of the pairs (a, b), a < b, of classes that meet and may reach the threshold; of different labels (rep, label), if given."""
        classes = self._classes()
        if label is not None:
            classes = materialize(classes.join(label, "rep", "left").withColumn("label", F.coalesce("label", "rep")), "labelled")
        parts = len(self.classes)
        tables = [materialize(meeting(segment_keys(classes, k, parts), self.threshold), "fuzzy-pairs") for k in range(parts)]
        if label is not None:
            drop_materialized(classes)
        crowded = reduce(DataFrame.unionByName, tables).where("b is null")
        ids = materialize(crowded.select(F.col("a").alias("id")).distinct(), "crowd")
        if not ids.isEmpty():
            crowd = self._prefixes(ids)
            tables += [materialize(crowd_pairs(crowd, k, crowd.parts, label), "crowd-pairs") for k in range(crowd.parts)]
            drop_materialized(crowd.texts)
        drop_materialized(ids)
        return _all(tables, "met-pairs")

    def _prefixes(self, ids: DataFrame) -> Prefixes:
        """The prefixes of the classes `ids` (id)."""
        part, wanted = only(self.rows, ids)
        texts = prefixes(part, self.shingle, self.threshold, wanted, self.sketch).join(ids, "id", "left_semi").dropDuplicates(["id"]).withColumnRenamed("id", "rep")
        texts = materialize(texts, "prefixes")
        members_of = texts.agg(F.coalesce(F.sum(F.size("tokens")), F.lit(0))).first()[0]
        return Prefixes(texts, self.threshold, n_parts(members_of))

    def stars(self) -> DataFrame:
        """A table of the pairs (a, b) of each key's least class and another one that may reach the threshold."""
        parts = len(self.classes)
        return _all([materialize(meeting(segment_keys(self._classes(), k, parts), self.threshold, star=True), "star-pairs") for k in range(parts)], "stars")

    def drop(self) -> None:
        """Delete the tables of the classes; `members` stays."""
        for table in self.classes:
            drop_materialized(table)

    def links(self, pairs: DataFrame) -> DataFrame:
        """(a, b, similarity) of the pairs that reach the threshold, by their whole sets."""
        likely = materialize(possible_pairs(pairs, self._classes().select("rep", "n", *PARITY), self.threshold), "candidates")
        wanted = materialize(likely.select(F.col("a").alias("id")).union(likely.select("b")).distinct(), "candidate-ids")
        sets = shingle_sets(*_args(self.rows, wanted, self.shingle)).groupBy("id").agg(F.max("grams").alias("grams"))
        both = likely.join(sets.select(F.col("id").alias("a"), F.col("grams").alias("ga")), "a").join(sets.select(F.col("id").alias("b"), F.col("grams").alias("gb")), "b")
        common = F.size(F.array_intersect("ga", "gb"))
        similar = both.select("a", "b", (common / (F.size("ga") + F.size("gb") - common)).alias("similarity"))
        return similar.where(F.col("similarity") >= self.threshold)


def _all(tables: list[DataFrame], name: str) -> DataFrame:
    """One table of the distinct pairs of all, which are removed."""
    out = materialize(reduce(DataFrame.unionByName, tables).where("b is not null").distinct(), name)
    for table in tables:
        drop_materialized(table)
    return out


def _args(rows: DataFrame, wanted: DataFrame, shingle: int) -> tuple[DataFrame, int, Broadcast | None]:
    part, bits = only(rows, wanted)
    return part, shingle, bits


def possible_pairs(pairs: DataFrame, sizes: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) that can still reach the threshold, judged without their sets.

    No pair is lost. The parities take a tenth of the room of the sets.
    """
    a = sizes.select(F.col("rep").alias("a"), F.col("n").alias("na"), *[F.col(p).alias(p + "a") for p in PARITY])
    b = sizes.select(F.col("rep").alias("b"), F.col("n").alias("nb"), *[F.col(p).alias(p + "b") for p in PARITY])
    return pairs.join(a, "a").join(b, "b").where(_may_reach(F.col("na"), F.col("nb"), threshold, PARITY)).select("a", "b")


def _one_text_an_id(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame | None, int]:
    """(rows (id, text); names (id, doc) of the ids that had several texts, each of which now has an id of its own; characters)."""
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).where("id is not null and text is not null")
    h = F.xxhash64("text")
    seen = materialize(rows.groupBy("id").agg((F.min(h) != F.max(h)).alias("differ"), F.sum(F.length("text")).alias("chars")), "texts")
    facts = seen.agg(F.coalesce(F.sum("chars"), F.lit(0)).alias("chars"), F.coalesce(F.bool_or("differ"), F.lit(False)).alias("any")).first()
    if not facts["any"]:
        drop_materialized(seen)
        return rows, None, facts["chars"]
    own = F.when(F.col("differ"), F.xxhash64("id", "text")).otherwise(F.col("id"))
    rows = rows.join(seen.where("differ").select("id", "differ"), "id", "left").select(own.alias("id"), "text", F.when(F.col("differ"), F.col("id")).alias("doc"))
    return rows.select("id", "text"), materialize(rows.where("doc is not null").select("id", "doc").distinct(), "several-texts"), facts["chars"]


def meet(docs: DataFrame, doc_id: str, text: str, shingle: int, threshold: float, min_words: int) -> Meeting:
    spark: SparkSession = docs.sparkSession
    ship_package(spark)
    rows, names, chars = _one_text_an_id(docs, doc_id, text)
    bits = min(max(int(chars // 64).bit_length(), SKETCH_BITS[0]), SKETCH_BITS[1])
    sketch = spark.sparkContext.broadcast(count_sketch(rows.select("text"), shingle, bits))
    prints = materialize(fingerprints(rows, shingle, max(min_words, shingle), sketch), "fingerprints")
    names_of = prints.groupBy("c1", "c2").agg(F.min("id").alias("rep"), F.count_distinct("id").alias("n_copies"))
    parts = n_parts(prints.count() * SLOTS)
    firsts = [F.min("id").alias("rep"), *[F.first(c).alias(c) for c in ("segments", "n", *PARITY)]]
    of_part = (prints.where(F.pmod("c1", F.lit(parts)) == k).groupBy("c1", "c2").agg(*firsts) for k in range(parts))
    classes = [materialize(own.drop("c1", "c2"), "classes") for own in of_part]
    members = prints.select("id", "c1", "c2").join(names_of, ["c1", "c2"]).select("id", "rep", "n_copies").distinct()
    if names is not None:
        docs_of = members.join(names, "id", "left").select(F.coalesce("doc", "id").alias("id"), "rep").distinct()
        members = docs_of.join(docs_of.groupBy("rep").agg(F.count("*").alias("n_copies")), "rep").select("id", "rep", "n_copies")
    members = materialize(members, "members")
    drop_materialized(prints)
    return Meeting(rows, members, classes, sketch, shingle, threshold)


def near_duplicate_classes(
    docs: DataFrame, doc_id: str, text: str, shingle: int = 5, threshold: float = 0.8, min_words: int = 20
) -> tuple[DataFrame, DataFrame]:
    """Classes of equal texts and the links between them.

    Returns members (id, rep, n_copies): one row per id and class, where rep is the least id of the
    class; and links (a, b, similarity) with a < b: pairs of class representatives that share at
    least `threshold` of the distinct `shingle`-word sequences occurring in either.

    Words are maximal runs of Unicode letters and digits, letter case ignored. NULL ids, NULL texts
    and texts of fewer than `min_words` words are in no class. Rows repeated under one id count
    once; if their texts differ, the id is in the class of each, and a hash stands for it where it
    would be a rep. Texts of any length are taken whole. Extra columns are ignored; an empty input
    gives two empty frames.
    """
    m = meet(docs, doc_id, text, shingle, threshold, min_words)
    pairs = m.pairs()
    links = m.links(pairs)
    drop_materialized(pairs)
    m.drop()
    return m.members, links


def expand_pairs(members: DataFrame, links: DataFrame, block: int = 256) -> DataFrame:
    """All pairs of ids (a < b) that are equal or linked: as many as the result has, so only where pairs are wanted.

    The ids of a large class are cut into blocks of about `block`, and each pair of blocks is a join key of its own.
    """
    m = members.select("id", "rep")
    many = members.where("n_copies > 1").select("id", "rep", F.ceil(F.col("n_copies") / block).cast("int").alias("_k"))
    many = many.withColumn("_b", F.pmod(F.xxhash64("id"), F.col("_k")).cast("int"))
    # a pair is found under (lower block, upper block); within one block under (block, block)
    x = many.select(F.col("id").alias("x"), "rep", F.col("_b").alias("_i"), F.explode(F.sequence("_b", F.col("_k") - 1)).alias("_j"))
    y = many.select(F.col("id").alias("y"), "rep", F.col("_b").alias("_j"), F.explode(F.sequence(F.lit(0), "_b")).alias("_i"))
    inside = x.join(y, ["rep", "_i", "_j"]).where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    across = (
        links.join(m.select(F.col("id").alias("ia"), F.col("rep").alias("a")), "a")
        .join(m.select(F.col("id").alias("ib"), F.col("rep").alias("b")), "b")
        .where("ia <> ib")
        .select(F.least("ia", "ib").alias("a"), F.greatest("ia", "ib").alias("b"))
    )
    return inside.unionByName(across).distinct()


def components(links: DataFrame) -> DataFrame:
    """(rep, label) of all classes with a link: the least class of the connected component.

    Each round every class takes the least label of its neighbours and then its label's own label
    (pointer jumping), until none changes; one table per round in the shared folder, nothing on the
    driver but whether there was a change.
    """
    edges = materialize(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = materialize(edges.select(F.col("a").alias("rep"), F.col("a").alias("label")).distinct(), "labels")
    while True:
        around = edges.join(labels.select(F.col("rep").alias("b"), F.col("label").alias("_l")), "b").groupBy(F.col("a").alias("rep")).agg(F.min("_l").alias("_near"))
        near = labels.join(around, "rep").select("rep", F.least("label", "_near").alias("_new"), F.col("label").alias("_old"))
        hop = labels.select(F.col("rep").alias("_new"), F.col("label").alias("_far"))
        labels2 = materialize(near.join(hop, "_new").select("rep", F.least("_new", "_far").alias("label"), "_old"), "labels")
        drop_materialized(labels)
        if labels2.where("label <> _old").isEmpty():
            drop_materialized(edges)
            return labels2.select("rep", "label")
        labels = materialize(labels2.select("rep", "label"), "labels")
        drop_materialized(labels2)


def near_duplicate_groups(
    docs: DataFrame, doc_id: str, text: str, shingle: int = 5, threshold: float = 0.8, min_words: int = 20
) -> DataFrame:
    """(id, group_id, n_copies): the connected groups that the links of `near_duplicate_classes` make, without making all links.

    group_id is the least id of the group. First the classes of each key are compared with the key's
    least class only; then, where classes of different groups still share a key, or prefixes, these are
    compared across the groups. A group of n texts so takes in the order of n comparisons, and no link
    that joins two groups is missed. Inputs as there; an id with differing texts has a row for each of its groups.
    """
    m = meet(docs, doc_id, text, shingle, threshold, min_words)
    stars = m.stars()
    near = materialize(m.links(stars), "star-links")
    drop_materialized(stars)
    label = components(near)
    cross = m.pairs(label)
    more = materialize(m.links(cross), "cross-links")
    drop_materialized(cross)
    m.drop()
    label = label if more.isEmpty() else components(near.select("a", "b").unionByName(more.select("a", "b")))
    linked = m.members.join(label, "rep").groupBy("label").agg(F.min("id").alias("_least"))
    of = label.join(linked, "label").select("rep", "_least")
    alone = m.members.groupBy("rep").agg(F.min("id").alias("_own"))
    return (
        m.members.join(of, "rep", "left").join(alone, "rep")
        .select("id", F.coalesce("_least", "_own").alias("group_id"), "n_copies")
        .groupBy("id", "group_id").agg(F.max("n_copies").alias("n_copies"))
    )
