"""Mixing sources to target shares of the total size in tokens.

Token weights of the cells (source, language, topic) are raked by iterative proportional fitting to
the source targets and to the corpus's own language and topic shares; a document of a cell is then
taken floor(w) times and once more with probability w - floor(w), w being the calibrated weight of
its cell. A cell table (sources x languages x topics) of up to `DRIVER_CELLS` rows is raked on the
driver, a larger one by aggregates over its rows, with the same steps.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from editlume.session import drop_materialized, materialize, ship_package

DRIVER_CELLS = 200_000
ROUNDS = 50
CLOSE = 1e-6  # relative change of every weight at which raking ends


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str):  # noqa: ANN202
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def count_tokens(docs: DataFrame, text: str, ranks_path: str, pattern: str) -> DataFrame:
    """Adds n_tokens (0 for a NULL text) by the byte-level BPE whose ranks lie at `ranks_path` on every worker.

    The text column is dropped: what follows needs sizes only.
    """
    kept = [c for c in docs.columns if c != text]
    ship_package(docs.sparkSession)
    schema = docs.select(*kept).schema.add("n_tokens", "long")
    at = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(ranks_path, pattern).encode_ordinary
        for batch in batches:
            sizes = [len(encode(t)) if t else 0 for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(sizes, pa.int64())], names=[*kept, "n_tokens"])

    return docs.select(*kept, text).mapInArrow(run, schema)


def main_language(lang: Column) -> Column:
    """The primary tag in lower case; 'und' if there is none."""
    tag = F.lower(F.trim(F.regexp_extract(lang, r"^\s*([A-Za-z]+)", 1)))
    return F.when(F.coalesce(tag, F.lit("")) == "", "und").otherwise(tag)


@dataclass
class Plan:
    """The raked weights: copies per document of each cell, and the total they add up to."""

    cells: list[tuple[str, str, str, float]]
    total: float


def rake(cells: list[tuple[str, str, str, int]], targets: dict[str, tuple[float, int]], rounds: int = ROUNDS) -> Plan:
    """Iterative proportional fitting of the cells' token weights under the caps of their sources.

    cells: (source, language, topic, tokens); targets: source -> (share, cap). Sources without
    tokens cannot contribute: the others keep their proportions. The total is the largest at which
    no source needs more than cap passes; each source's share is then met exactly, as the source
    margin is fitted last and a cell over its cap gives the surplus to the source's other cells.
    """
    have = [c for c in cells if c[3] > 0 and c[0] in targets and targets[c[0]][0] > 0 and targets[c[0]][1] > 0]
    if not have:
        return Plan([], 0.0)
    tokens = np.array([c[3] for c in have], dtype=float)
    axes = []
    for k in range(3):
        names, at = np.unique(np.array([c[k] for c in have], dtype=object), return_inverse=True)
        axes.append((names.tolist(), at))
    sources, src = axes[0]
    share = np.array([targets[s][0] for s in sources])
    share = share / share.sum()
    cap = np.array([targets[s][1] for s in sources], dtype=float)
    by_source = np.bincount(src, weights=tokens)
    total = float((cap * by_source / share).min())
    weight = tokens * (share * total / by_source)[src]
    limit = tokens * cap[src]
    margins = [np.bincount(ix, weights=tokens) / tokens.sum() * total for _, ix in axes[1:]]
    for _ in range(rounds):
        last = weight
        for (_, ix), want in zip(axes[1:], margins):
            now = np.bincount(ix, weights=weight)
            weight = weight * np.divide(want, now, out=np.ones_like(now), where=now > 0)[ix]
        weight = _to_source(weight, limit, src, share * total)
        if np.allclose(weight, last, rtol=CLOSE, atol=0):
            break
    return Plan([(*c[:3], float(w / t)) for c, w, t in zip(have, weight, tokens)], total)


def _to_source(weight: np.ndarray, limit: np.ndarray, src: np.ndarray, want: np.ndarray) -> np.ndarray:
    """Scale each source to its wanted size, no cell beyond its limit (a cell at it is held, the rest scaled on)."""
    for _ in range(len(weight) + 1):
        held = weight >= limit * (1 - 1e-12)
        free = np.bincount(src, weights=np.where(held, 0, weight), minlength=len(want))
        left = want - np.bincount(src, weights=np.where(held, limit, 0), minlength=len(want))
        factor = np.divide(left, free, out=np.ones_like(free), where=free > 0)
        new = np.where(held & (factor[src] >= 1), limit, np.minimum(weight * factor[src], limit))
        if np.allclose(new, weight, rtol=1e-13):
            return new
        weight = new
    return weight


def rake_rows(cells: DataFrame, targets: dict[str, tuple[float, int]], rounds: int = ROUNDS) -> DataFrame:
    """As `rake`, for a cell table of any size (source, lang, topic, tokens): (source, lang, topic, w).

    Each fitting of a margin is an aggregate over the cells and a join; the state of a round is a table
    in the shared folder. Only numbers per target source come to the driver.
    """
    goal = {s: (a, c) for s, (a, c) in targets.items() if a > 0 and c > 0}
    have = cells.where((F.col("tokens") > 0) & F.col("source").isin(list(goal))).select("source", "lang", "topic", F.col("tokens").cast("double").alias("tokens"))
    by_source = {r["source"]: r["t"] for r in have.groupBy("source").agg(F.sum("tokens").alias("t")).collect()}
    if not by_source:
        return have.select("source", "lang", "topic", F.lit(0.0).alias("w")).limit(0)
    shares = sum(goal[s][0] for s in by_source)
    total = min(goal[s][1] * t * shares / goal[s][0] for s, t in by_source.items())
    want = {s: goal[s][0] / shares * total for s in by_source}
    whole = sum(by_source.values())
    per = lambda values: F.coalesce(*[F.when(F.col("source") == s, F.lit(float(v))) for s, v in values.items()])
    state = materialize(have.withColumn("limit", F.col("tokens") * per({s: goal[s][1] for s in by_source})).withColumn("weight", F.col("tokens") * per({s: want[s] / t for s, t in by_source.items()})), "cell-weights")
    for _ in range(rounds):
        fitted = state.withColumn("before", F.col("weight"))
        for axis in ("lang", "topic"):
            sums = fitted.groupBy(axis).agg(F.sum("weight").alias("_now"), (F.sum("tokens") / whole * total).alias("_want"))
            fitted = fitted.join(sums, axis).withColumn("weight", F.when(F.col("_now") > 0, F.col("weight") * F.col("_want") / F.col("_now")).otherwise(F.col("weight"))).drop("_now", "_want")
        fitted = materialize(fitted, "cell-weights")
        drop_materialized(state)
        now = F.col("weight")
        for _ in range(100):  # scale each source to its size; a cell at its limit is held, the rest scaled on
            held = now >= F.col("limit") * (1 - 1e-12)
            sums = {r["source"]: r for r in fitted.groupBy("source").agg(F.sum(F.when(held, 0.0).otherwise(now)).alias("free"), F.sum(F.when(held, F.col("limit")).otherwise(0.0)).alias("full")).collect()}
            factor = {s: (want[s] - r["full"]) / r["free"] if r["free"] > 0 else 1.0 for s, r in sums.items()}
            new = F.when(held & (per(factor) >= 1), F.col("limit")).otherwise(F.least(now * per(factor), F.col("limit")))
            step = materialize(fitted.withColumn("weight", new), "cell-weights")
            drop_materialized(fitted)
            fitted, now = step, F.col("weight")
            if all(abs(f - 1) < 1e-12 or sums[s]["free"] <= 0 for s, f in factor.items()):
                break
        state = fitted
        if state.where(F.abs(F.col("weight") - F.col("before")) > CLOSE * F.abs(F.col("before"))).isEmpty():
            break
    return state.select("source", "lang", "topic", (F.col("weight") / F.col("tokens")).alias("w"))


def margins(sized: DataFrame, chosen: DataFrame, goals: DataFrame) -> DataFrame:
    """(axis, name, target_share, actual_share, tokens_mixed) of every source, language and topic: the wanted and the reached share.

    Sources have the share of the targets, languages and topics that of the tokens available.
    """
    out: DataFrame | None = None
    for axis in ("source", "lang", "topic"):
        mixed = chosen.groupBy(axis).agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens_mixed"))
        if axis == "source":
            wanted = goals.select("source", "target_share")
        else:
            there = sized.groupBy(axis).agg(F.sum("n_tokens").alias("_t"))
            wanted = there.crossJoin(F.broadcast(there.agg(F.sum("_t").alias("_all")))).select(axis, (F.col("_t") / F.col("_all")).alias("target_share"))
        both = wanted.join(mixed, axis, "left").crossJoin(F.broadcast(mixed.agg(F.sum("tokens_mixed").alias("_all"))))
        tokens = F.coalesce("tokens_mixed", F.lit(0)).alias("tokens_mixed")
        part = both.select(F.lit(axis).alias("axis"), F.col(axis).alias("name"), "target_share", F.coalesce(F.col("tokens_mixed") / F.col("_all"), F.lit(0.0)).alias("actual_share"), tokens)
        out = part if out is None else out.unionByName(part)
    return out


def mix_sources(docs: DataFrame, targets: DataFrame, doc_id: str, buckets: int = 256, driver_cells: int = DRIVER_CELLS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(chosen documents, shares by source, `margins`).

    docs: doc_id, n_tokens, source, lang, topic; targets: source, target_share, max_repeats (one row per
    source; of repeated rows the largest values hold).
    Chosen: doc_id, source, lang, topic, n_tokens, copies (1 .. max_repeats). Shares: every target
    source with target_share, actual_share, tokens_available, tokens_mixed, n_docs, n_copies and
    most_copies; a source with no tokens has actual share 0 and the others keep their proportions.

    The extra copy of a document is drawn by systematic sampling with probability w - floor(w), along
    the order of size within its cell, so that each stretch of sizes is represented and shares come
    out nearly exact. Ranks along that order are made of counts per (cell, size) and per bucket of the
    id's hash within these, so no cell's documents are ordered in one task. Documents with NULL id, no source in the
    targets, or no tokens are not mixed; NULL language and topic are classes of their own. Rows
    repeated under one id count once (the largest sizes and names hold).
    """
    spark = docs.sparkSession
    goal = {r["source"]: (float(r["share"]), int(r["cap"])) for r in targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("share"), F.max("max_repeats").alias("cap")).collect()}
    base = docs.select(
        F.col(doc_id).cast("long").alias("id"), F.col("source"), main_language(F.col("lang")).alias("lang"),
        F.coalesce(F.col("topic").cast("string"), F.lit("none")).alias("topic"), "n_tokens",
    ).where(F.col("id").isNotNull() & F.col("source").isin(list(goal)))
    once = base.groupBy("id").agg(*[F.max(c).alias(c) for c in ("source", "lang", "topic", "n_tokens")])
    sized = materialize(once.where("n_tokens > 0"), "sized")
    cells = sized.groupBy("source", "lang", "topic").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs"))
    rows = cells.limit(driver_cells + 1).collect()
    if len(rows) <= driver_cells:
        plan = rake([(r["source"], r["lang"], r["topic"], r["tokens"]) for r in rows], goal)
        size_of = {(r["source"], r["lang"], r["topic"]): r["docs"] for r in rows}
        drawn: dict[str, float] = {}
        placed = []
        for s, lang, topic, w in sorted(plan.cells):  # the draw runs on from cell to cell, so a source is off by one document at most
            placed.append((s, lang, topic, w, drawn.setdefault(s, 0.5)))
            drawn[s] = (drawn[s] + (w - float(np.floor(w))) * size_of[s, lang, topic]) % 1.0
        weights = F.broadcast(spark.createDataFrame(placed, "source string, lang string, topic string, w double, _start double"))
    else:  # a draw of its own in each cell
        start = F.pmod(F.xxhash64("source", "lang", "topic"), F.lit(1 << 20)) / F.lit(float(1 << 20))
        weights = rake_rows(materialize(cells.select("source", "lang", "topic", "tokens"), "cells"), goal).withColumn("_start", start)
    weighted = sized.join(weights, ["source", "lang", "topic"])
    bucket = F.pmod(F.xxhash64("id"), F.lit(buckets)).alias("_b")
    keyed = weighted.withColumn("_b", bucket)
    key = ["source", "lang", "topic"]
    counts = keyed.groupBy(*key, "n_tokens", "_b").agg(F.count("*").alias("_n"))
    per_size = counts.groupBy(*key, "n_tokens").agg(F.sum("_n").alias("_m"))
    smaller = F.sum("_m").over(Window.partitionBy(*key).orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, -1))
    earlier = F.sum("_n").over(Window.partitionBy(*key, "n_tokens").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))
    before = (
        counts.withColumn("_earlier", F.coalesce(earlier, F.lit(0)))
        .join(per_size.withColumn("_smaller", F.coalesce(smaller, F.lit(0))), [*key, "n_tokens"])
        .select(*key, "n_tokens", "_b", (F.col("_earlier") + F.col("_smaller")).alias("_before"))
    )
    inner = Window.partitionBy(*key, "n_tokens", "_b").orderBy(F.xxhash64("id", F.lit(1)), "id")
    ranked = keyed.join(before, [*key, "n_tokens", "_b"]).withColumn("_rank", F.col("_before") + F.row_number().over(inner))
    frac = F.col("w") - F.floor("w")
    extra = F.floor(F.col("_rank") * frac + F.col("_start")) - F.floor((F.col("_rank") - 1) * frac + F.col("_start"))
    chosen = ranked.select(
        F.col("id").alias(doc_id), *key, "n_tokens", (F.floor("w") + extra).cast("int").alias("copies")
    ).where("copies > 0")
    goals = spark.createDataFrame([(s, a, c) for s, (a, c) in goal.items()], "source string, target_share double, max_repeats int")
    mixed = chosen.groupBy("source").agg(
        F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens_mixed"), F.count("*").alias("n_docs"),
        F.sum("copies").alias("n_copies"), F.max("copies").alias("most_copies"),
    )
    stock = sized.groupBy("source").agg(F.sum("n_tokens").alias("tokens_available"))
    shares = goals.join(F.broadcast(mixed), "source", "left").join(F.broadcast(stock), "source", "left")
    total = F.sum("tokens_mixed").over(Window.partitionBy())
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    shares = shares.select(
        "source", "target_share", F.coalesce(F.col("tokens_mixed") / total, F.lit(0.0)).alias("actual_share"), "max_repeats",
        zero("tokens_available"), zero("tokens_mixed"), zero("n_docs"), zero("n_copies"), zero("most_copies"),
    )
    return chosen, shares, margins(sized, chosen, goals)
