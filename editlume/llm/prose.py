"""Keyword-stuffed, link-list and product-tag pages, by the perplexity of function words and word classes.

A text becomes a sequence of symbols, one per word: the word itself if it is one of its language's
function words, else its class (number, letters mixed with digits, capitalised, other; and whether
the same word came within the last few words), each joined with the kind of gap before it (blank,
clause mark, sentence end, line break, markup, glued dot).

A bigram model of prose is trained per language on the whole corpus: on sentences rich in function
words and on the words among these, so that what goes with sentences (captions, signatures, titles)
is learnt too. A word is out of prose where the model's surprisal, averaged over a window around it, is abnormally high or
abnormally low: more than `SPREAD` standard deviations from that of sentences. A page is flagged if
more than half of its words are out of prose.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from editlume.llm.mixing import main_language
from editlume.llm.textnum import Batch, U, Words, mix, pieces, words
from editlume.session import drop_materialized, materialize, ship_package, transient_shuffles

FUNCTION_WORDS = 100  # a language
SENTENCES = 200  # that a language must have to get a model
LANGUAGES = 256
RICH = 0.5  # of the density of function words in sentences
BESIDE = 0.5
SPREAD = 3.0
PIECE_WORDS = 300_000
PIECE_ROWS = 2000
WINDOW = 8
ECHO = 8
BLANK, CLAUSE, SENTENCE, BREAK, MARKUP, GLUED = range(6)
GAPS = 6
NUMBER, MIXED, CAPITAL, OTHER = range(4)
_OPENS = np.isin(np.arange(GAPS), (SENTENCE, BREAK, MARKUP, GLUED))
CLASSES = 8  # each also for words seen within the last ECHO words
KINDS = CLASSES + FUNCTION_WORDS
SYMBOLS = KINDS * GAPS


@lru_cache(maxsize=1)
def _char_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per code point: its lower case (if one code point), word-class bits, gap bits."""
    n = sys.maxunicode + 1
    lower = np.arange(n, dtype=np.uint32)
    word = np.zeros(n, dtype=np.uint8)
    gap = np.full(n, 16, dtype=np.uint8)
    for i in range(n):
        c = chr(i)
        low = c.lower()
        if len(low) == 1:
            lower[i] = ord(low)
        if c.isalnum():
            word[i] = 2 if not c.isalpha() else 4 if c.isupper() else 1
        if c.isspace():
            gap[i] = 1
    gap[ord("\n")] = gap[ord("\r")] = 2
    for c in ".!?…":
        gap[ord(c)] = 4
    for c in ",;:'’‘\"“”«»()[]-–—¿¡\xad́̀̂̈":
        gap[ord(c)] = 8
    return lower, word, gap


def lower_batch(texts: list[str]) -> tuple[Batch, np.ndarray]:
    """Code points lowered one by one, so that offsets stay those of the text; and the text's own."""
    raw = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    start = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=start[1:])
    return Batch(_char_tables()[0][raw], start), raw


Part = tuple[Words, np.ndarray, np.ndarray, np.ndarray]


def features(texts: list[str]) -> Part:
    """(words, class, gap before, followed by a sentence mark) of every word of the batch."""
    b, raw = lower_batch(texts)
    w = words(b)
    w.hash = w.hash >> U(32)  # as much as `encode` keeps
    if not len(w.begin):
        return w, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    _, word_bits, gap_bits = _char_tables()
    edges = np.empty(2 * len(w.begin), dtype=np.int64)
    edges[0::2], edges[1::2] = w.begin, w.end
    inside = np.bitwise_or.reduceat(word_bits[raw], w.begin)  # up to the next word; gaps have no word bits
    first = word_bits[raw[w.begin]]
    kind = np.full(len(w.begin), OTHER)
    kind[first == 4] = CAPITAL
    kind[(inside & 2 > 0) & (inside & 5 > 0)] = MIXED
    kind[inside == 2] = NUMBER
    echo = np.zeros(len(w.begin), dtype=bool)
    for d in range(1, min(ECHO, len(echo) - 1) + 1):
        echo[d:] |= (w.hash[d:] == w.hash[:-d]) & (w.doc[d:] == w.doc[:-d])
    kind = kind + 4 * echo
    after = np.zeros(len(w.begin), dtype=np.uint8)
    has = np.flatnonzero(np.append(w.begin[1:], len(raw)) > w.end)
    if len(has):
        pairs = np.empty(2 * len(has), dtype=np.int64)
        pairs[0::2] = w.end[has]
        pairs[1::2] = np.append(w.begin[1:], len(raw))[has]
        bits = gap_bits[raw]
        after[has] = np.bitwise_or.reduceat(np.append(bits, 0), pairs)[0::2]
    before = np.zeros(len(w.begin), dtype=np.uint8)
    before[1:] = after[:-1]
    gap = np.full(len(w.begin), BLANK)
    gap[before & 8 > 0] = CLAUSE
    gap[before & 4 > 0] = GLUED
    gap[before & 2 > 0] = BREAK
    gap[(before & 4 > 0) & (before & 3 > 0)] = SENTENCE
    gap[before & 16 > 0] = MARKUP
    starts = w.first[:-1][np.diff(w.first) > 0]
    gap[starts] = SENTENCE  # a text opens like a sentence
    return w, kind, gap, after & 4 > 0


def encode(texts: list[str]) -> tuple[list[bytes], list[bytes]]:
    """The features of each text as bytes: word hashes (32 bits), and class, gap and sentence mark (one byte a word)."""
    w, kind, gap, closes = features(texts)
    code = (kind | gap << 3 | closes.astype(np.int64) << 6).astype(np.uint8)
    h = w.hash.astype(np.uint32)
    ends = list(zip(w.first[:-1], w.first[1:]))
    return [h[i:k].tobytes() for i, k in ends], [code[i:k].tobytes() for i, k in ends]


def coder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, lang, text) to (id, lang, hashes, codes)."""
    for batch in batches:
        for piece in pieces(batch, 2):
            hashes, codes = encode(piece.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([*piece.columns[:2], pa.array(hashes, pa.binary()), pa.array(codes, pa.binary())], names=["id", "lang", "hashes", "codes"])


def decode(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, Part]]:
    """Slices of the rows (id, lang, hashes, codes) of about PIECE_WORDS words and at most PIECE_ROWS texts, and what `features` gave of these."""
    total = np.concatenate(([0], np.cumsum(pc.binary_length(batch.column(3)).to_numpy().astype(np.int64))))
    at = 0
    while at < batch.num_rows:
        upto = min(max(at + 1, int(np.searchsorted(total, total[at] + PIECE_WORDS, side="right")) - 1), at + PIECE_ROWS)
        piece = batch.slice(at, upto - at)
        h = np.frombuffer(b"".join(piece.column(2).to_pylist()), dtype=np.uint32).astype(U)
        code = np.frombuffer(b"".join(piece.column(3).to_pylist()), dtype=np.uint8).astype(np.int64)
        first = total[at : upto + 1] - total[at]
        none = np.zeros(0, np.int64)
        yield piece, (Words(none, none, np.repeat(np.arange(upto - at), np.diff(first)), first, h), code & 7, code >> 3 & 7, code >> 6 > 0)
        at = upto


def sentence_mask(gap: np.ndarray, closes: np.ndarray, least: int = 5, most: int = 60) -> np.ndarray:
    """Words of stretches that end as sentences do and have no markup, line break or glued dot within."""
    n = len(gap)
    if not n:
        return np.zeros(0, bool)
    at = np.flatnonzero(_OPENS[gap])
    size = np.diff(np.append(at, n))
    good = (size >= least) & (size <= most) & closes[np.append(at[1:], n) - 1] & (np.append(gap[at[1:]], SENTENCE) != GLUED)
    return np.repeat(good, size)


def window_means(w: Words, values: np.ndarray) -> np.ndarray:
    """Mean over the words at most WINDOW away within the same text."""
    total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    k = np.arange(len(values))
    lo = np.maximum(k - WINDOW, w.first[w.doc])
    hi = np.minimum(k + WINDOW + 1, w.first[w.doc + 1])
    return (total[hi] - total[lo]) / (hi - lo)


def among(h: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Which of the 32-bit hashes are `chosen` (sorted): only those that agree in 16 bits with one are looked up."""
    some = np.zeros(1 << 16, dtype=bool)
    some[(chosen & U(0xFFFF)).astype(np.int64)] = True
    known = some[(h & U(0xFFFF)).astype(np.int64)]
    at = np.flatnonzero(known)
    if len(at):
        known[at] = chosen[np.minimum(np.searchsorted(chosen, h[at]), len(chosen) - 1)] == h[at]
    return known


@dataclass
class ProseModel:
    """By language: function words, and bits of the symbol b after a word of the kind a. Under 0.3 MB a language."""

    names: list[str]
    density: np.ndarray  # share of function words in the words of sentences
    hashes: np.ndarray  # sorted hashes of all function words
    first: np.ndarray  # the entries of word k are first[k]:first[k + 1]
    lang: np.ndarray  # of each entry
    rank: np.ndarray  # of each entry: the word's place among its language's
    bits: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float16))  # languages x KINDS x SYMBOLS
    low: np.ndarray = field(default_factory=lambda: np.zeros(0))  # per language: surprisal of windows is normal from here
    high: np.ndarray = field(default_factory=lambda: np.zeros(0))  # to here

    def read(self, part: Part) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language of each text, kind of each word, pair of each word): the language is the one with most function words in the text."""
        w, kind, gap, _ = part
        texts, n = len(w.first) - 1, len(self.names)
        known = np.flatnonzero(among(w.hash, self.hashes))
        at = np.searchsorted(self.hashes, w.hash[known])
        size = self.first[at + 1] - self.first[at]
        entry = np.repeat(self.first[at] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        word = np.repeat(known, size)
        doc = w.doc[word]
        best = np.bincount(doc * n + self.lang[entry], minlength=texts * n).reshape(texts, n).argmax(axis=1)
        mine = self.lang[entry] == best[doc]
        kind = kind.copy()
        kind[word[mine]] = self.rank[entry[mine]] + CLASSES
        before = np.empty_like(kind)
        before[1:] = kind[:-1]
        before[w.first[:-1][np.diff(w.first) > 0]] = OTHER  # a text opens after an ordinary word
        return best, kind, (best[w.doc] * KINDS + before) * SYMBOLS + kind * GAPS + gap

    def surprisal(self, pair: np.ndarray) -> np.ndarray:
        return self.bits[pair].astype(np.float32)

    def score(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: words, share of them out of prose, perplexity under the prose model."""
        return self.score_part(features(texts))

    def score_part(self, part: Part) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        w, n = part[0], np.diff(part[0].first)
        if not len(w.hash) or not self.names:
            return n, np.zeros(len(n)), np.ones(len(n))
        best, _, pair = self.read(part)
        bits = self.surprisal(pair)
        mean = window_means(w, bits)
        out = (mean < self.low[best][w.doc]) | (mean > self.high[best][w.doc])
        add = lambda x: np.bincount(w.doc, weights=x, minlength=len(n)) / np.maximum(n, 1)
        return n, add(out), 2.0 ** add(bits)


INSIDE, COUNT = -2, -1  # keys of other numbers than words: words in sentences, sentences


def sentence_words(part: Part, label: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(label, word, number of sentences with it), and per label the numbers COUNT and INSIDE; `label`: of each text."""
    w, _, gap, closes = part
    m = np.flatnonzero(sentence_mask(gap, closes))
    if not len(m):
        return (np.zeros(0, np.int64),) * 3
    opens = _OPENS[gap[m]]
    sentence = np.cumsum(opens) - 1
    of = label[w.doc[m]]
    once = np.unique(sentence.astype(U) << U(32) | w.hash[m])
    both = of[np.flatnonzero(opens)][(once >> U(32)).astype(np.int64)].astype(U) << U(32) | once & U(0xFFFFFFFF)
    both, n = np.unique(both, return_counts=True)
    labels, sentences = np.unique(of[opens], return_counts=True)
    inside = np.bincount(of, minlength=labels.max() + 1)[labels]
    fill = lambda key: np.full(len(labels), key)
    return (
        np.concatenate(((both >> U(32)).astype(np.int64), labels, labels)),
        np.concatenate(((both & U(0xFFFFFFFF)).astype(np.int64), fill(COUNT), fill(INSIDE))),
        np.concatenate((n, sentences, inside)),
    )


def prose_pairs(part: Part, model: ProseModel) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of the words of rich sentences, and of the other words in whose window those make up at least `BESIDE`."""
    w, _, gap, closes = part
    best, kind, pair = model.read(part)
    m = np.flatnonzero(sentence_mask(gap, closes))
    opens = _OPENS[gap[m]]
    sentence = np.cumsum(opens) - 1
    good = np.bincount(sentence, weights=kind[m] >= CLASSES) >= RICH * model.density[best[w.doc[m]]][opens] * np.bincount(sentence)
    rich = np.zeros(len(pair), dtype=bool)
    rich[m] = good[sentence]
    return pair[rich], pair[~rich & (window_means(w, rich) >= BESIDE)]


def fit_language(pair: np.ndarray, rich: np.ndarray, other: np.ndarray, spread: float = SPREAD, back: float = 8.0) -> tuple[np.ndarray, float, float]:
    """Bits of each pair from its counts, backed off to those of the symbol alone; low and high bound of windows in rich sentences."""
    counts = np.zeros(KINDS * SYMBOLS)
    counts[pair] = rich + other
    counts = counts.reshape(KINDS, SYMBOLS)
    single = counts.sum(axis=0)
    uni = (single + 0.1) / (single.sum() + 0.1 * SYMBOLS)
    bits = (-np.log2((counts + back * uni[None, :]) / (counts.sum(axis=1, keepdims=True) + back))).astype(np.float16).reshape(-1)
    mine, n = bits[pair].astype(float), max(1, rich.sum())
    mean = (mine * rich).sum() / n
    # windows of independent words would vary by this; those of sentences vary by about as much
    deviation = np.sqrt(((mine - mean) ** 2 * rich).sum() / n / (2 * WINDOW + 1))
    return bits, mean - spread * deviation, mean + spread * deviation


def choose_words(counts: list[tuple[str, int, int]], sentences: dict[str, int], inside: dict[str, int]) -> ProseModel:
    """The model without bits; counts: (language, word, sentences with it), of each language at most FUNCTION_WORDS."""
    names = sorted(sentences, key=lambda k: (-sentences[k], k))
    by: dict[str, list[tuple[int, int]]] = {k: [] for k in names}
    for name, key, n in counts:
        by[name].append((-n, key))
    rows = [(key, i, rank) for i, name in enumerate(names) for rank, (_, key) in enumerate(sorted(by[name])[:FUNCTION_WORDS])]
    density = np.array([min(1.0, -sum(n for n, _ in by[k]) / max(1, inside.get(k, 0))) for k in names])
    rows.sort()
    key, lang, rank = (np.array([r[c] for r in rows], dtype=np.int64) for c in range(3))
    hashes, first = np.unique(key, return_index=True)
    return ProseModel(names, density, hashes.astype(U), np.append(first, len(key)), lang, rank)


def train_on(coded: DataFrame, sentences: int = SENTENCES) -> ProseModel:
    """The model of all rows (id, lang, hashes, codes), in two passes of partial counts.

    Function words are, by language, the FUNCTION_WORDS words found in most sentences (in at least
    0.5 % of them), so a small language has its own. The languages are the values of `lang` with at least
    `sentences` sentences (the LANGUAGES largest of them, which bounds the model's size), or all rows
    together if there is none. Other texts are read by the model they share most function words with.
    Models are made in the executors, a language a task. Without sentences there is no model, which flags nothing.
    """
    spark = coded.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, part in decode(batch):
                names = pc.dictionary_encode(piece.column(1))
                label, key, n = sentence_words(part, names.indices.to_numpy())
                yield pa.RecordBatch.from_arrays([names.dictionary.take(pa.array(label)), pa.array(key), pa.array(n)], names=["lang", "key", "n"])

    sums = materialize(coded.mapInArrow(count, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n")), "word-counts")
    large = sums.where((F.col("key") == COUNT) & (F.col("n") >= sentences)).orderBy(F.col("n").desc(), "lang").limit(LANGUAGES).collect()
    found = {r["lang"]: r["n"] for r in large}
    per = sums.where(F.col("lang").isin(list(found)))
    if not found:
        per = sums.groupBy("key").agg(F.sum("n").alias("n")).select(F.lit("").alias("lang"), "key", "n")
        found = {r["lang"]: r["n"] for r in per.where(F.col("key") == COUNT).collect()}
    inside = {r["lang"]: r["n"] for r in per.where(F.col("key") == INSIDE).collect()}
    share = F.coalesce(*[F.when(F.col("lang") == k, n * 0.005) for k, n in found.items()], F.lit(0.0))
    top = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "key"))
    best = per.where((F.col("key") >= 0) & (F.col("n") > F.greatest(share, F.lit(3)))).withColumn("_k", top).where(F.col("_k") <= FUNCTION_WORDS).collect()
    drop_materialized(sums)
    model = choose_words([(r["lang"], r["key"], r["n"]) for r in best], found, inside)
    return _fitted(coded, model) if model.names else model


def _fitted(coded: DataFrame, model: ProseModel) -> ProseModel:
    """The model with bits and bounds."""
    spark = coded.sparkSession
    sent = spark.sparkContext.broadcast(model)
    size = KINDS * SYMBOLS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, part in decode(batch):
                if not len(part[1]):
                    continue
                for k, pair in enumerate(prose_pairs(part, sent.value)):
                    for lang in np.unique(pair // size).tolist():
                        mine = pair[pair // size == lang] - lang * size
                        sums.setdefault(lang, np.zeros((2, size), dtype=np.int64))[k] += np.bincount(mine, minlength=size)
        for lang, n in sums.items():
            at = np.flatnonzero(n.any(axis=0))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), lang)), pa.array(at), pa.array(n[0][at]), pa.array(n[1][at])], names=["lang", "pair", "rich", "other"])

    def fit(rows: pa.Table) -> pa.Table:
        bits, low, high = fit_language(*(rows.column(c).to_numpy() for c in ("pair", "rich", "other")))
        return pa.table({"lang": rows.column("lang").slice(0, 1), "bits": pa.array([bits.tobytes()], pa.binary()), "low": [low], "high": [high]})

    sums = coded.mapInArrow(count, "lang long, pair long, rich long, other long").groupBy("lang", "pair").agg(F.sum("rich").alias("rich"), F.sum("other").alias("other"))
    with transient_shuffles(spark):
        fitted = sums.groupBy("lang").applyInArrow(fit, "lang long, bits binary, low double, high double").collect()
    n = len(model.names)
    bits, low, high = np.zeros((n, size), np.float16), np.zeros(n), np.full(n, np.inf)  # a language without rich sentences flags nothing
    for r in fitted:
        bits[r["lang"]], low[r["lang"]], high[r["lang"]] = np.frombuffer(bytes(r["bits"]), np.float16), r["low"], r["high"]
    sent.destroy()
    return ProseModel(model.names, model.density, model.hashes, model.first, model.lang, model.rank, bits.reshape(-1), low, high)


def flag_pages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", share: float = 0.5, sentences: int = SENTENCES) -> DataFrame:
    """(doc_id, n_words, out_share, perplexity, flagged) of every document with a text.

    The models are fitted on all documents, without labels of what is spam; all documents are scored,
    over their whole texts. `lang` (may be absent, NULL or wrong) only tells which rows' words are counted
    together; a text's own words decide by which language it is read. flagged: out_share > `share`.
    NULL ids and NULL texts have no row, a text without words is not flagged; rows repeated
    under one id count once (of differing texts the one with the largest share holds). Extra columns
    are ignored; an empty input gives an empty result.
    """
    spark = docs.sparkSession
    ship_package(spark)
    label = main_language(F.col(lang).cast("string")) if lang in docs.columns else F.lit("und")
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), label.alias("lang"), F.col(text).alias("text")).where("id is not null and text is not null")
    coded = materialize(rows.mapInArrow(coder, "id long, lang string, hashes binary, codes binary"), "word-codes")
    model = spark.sparkContext.broadcast(train_on(coded, sentences))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, part in decode(batch):
                n, out, perplexity = model.value.score_part(part)
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(n, pa.int64()), pa.array(out), pa.array(perplexity)], names=["id", "n", "out", "perplexity"])

    scored = coded.mapInArrow(run, "id long, n long, out double, perplexity double")
    one = scored.groupBy("id").agg(F.max(F.struct("out", "n", "perplexity")).alias("_s"))
    return one.select(
        F.col("id").alias(doc_id), F.col("_s.n").alias("n_words"), F.col("_s.out").alias("out_share"), F.col("_s.perplexity").alias("perplexity"),
        (F.col("_s.out") > share).alias("flagged"),
    )
