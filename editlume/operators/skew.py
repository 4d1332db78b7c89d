"""Work on keys of which a few hold most rows.

`salted_aggregate` is the two-stage aggregation; `heavy_keys` finds the keys that need it and
`heavy_join` joins on such keys without sending one key's rows to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def heavy_keys(df: DataFrame, key: str, share: float = 0.01) -> DataFrame:
    """Keys holding at least `share` of the rows with a key: at most 1/share rows, so safe to broadcast.

    One pass with partial aggregation; the counts of light keys never leave the final stage.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n").alias("_total"))
    return counts.crossJoin(F.broadcast(total)).where(F.col("_n") >= share * F.col("_total")).select("_key")


def salted_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    distinct_on: str,
    firsts: dict[str, Column],
    merge: dict[str, tuple[Column, Column]],
    rows_per_salt: int = 100_000,
    heavy_share: float = 0.01,
) -> DataFrame:
    """Results per key (of one or more columns) in two stages, the heavy keys salted.

    Rows repeated under one `distinct_on` value count once per key: stage 0 folds them with `firsts`
    (alias -> aggregate over the repeated rows), hash-partitioned by (key, salt, distinct_on).
    Stage 1 computes, per (key, salt), the partial aggregates `merge[alias][0]`; stage 2 merges
    them per key with `merge[alias][1]`, an aggregate over the column `alias`. A heavy key (at least
    `heavy_share` of the rows) has a salt for every `rows_per_salt` of its rows. The salt is a hash of
    `distinct_on`: as good as a random one at spreading rows, yet the same again when a lost task is
    repeated, and equal for repeated rows. Light keys get salt 0 and so take a single partial.

    Rows with a NULL in the key are dropped. An empty input gives an empty result.
    """
    rows = df
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    counts = rows.groupBy(*[F.col(k).alias(f"_h{i}") for i, k in enumerate(keys)]).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n").alias("_total"))
    hot = counts.crossJoin(F.broadcast(total)).where(F.col("_n") >= heavy_share * F.col("_total"))  # 1 / heavy_share at most
    hot = hot.select(*[f"_h{i}" for i in range(len(keys))], F.ceil(F.col("_n") / rows_per_salt).alias("_salts"))
    marked = rows.join(F.broadcast(hot), [rows[k] == hot[f"_h{i}"] for i, k in enumerate(keys)], "left")
    salt = F.coalesce(F.pmod(F.xxhash64(F.col(distinct_on)), F.col("_salts")), F.lit(0)).alias("_salt")
    names = [f"_k{i}" for i in range(len(keys))]
    # the hash partitioning on (key, salt, id) is finer than (key, salt), so stage 1 shuffles only partials
    once = marked.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)], salt, F.col(distinct_on).alias("_id")).agg(*[c.alias(a) for a, c in firsts.items()])
    partial = once.groupBy(*names, "_salt").agg(*[p.alias(a) for a, (p, _) in merge.items()])
    return partial.groupBy(*[F.col(n).alias(k) for k, n in zip(keys, names)]).agg(*[m.alias(a) for a, (_, m) in merge.items()])


def heavy_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    right_key: str,
    columns: Sequence[str],
    how: str = "left",
    share: float = 0.01,
) -> DataFrame:
    """Equi-join (`left` or `inner`) of skewed `left` with `right`, which has one row per `right_key`.

    The rows of `right` for the heavy keys (at most 1/share of them, by construction) are
    broadcast, all other keys go through an ordinary shuffled join. `columns` of `right` are added.
    NULL keys find no partner.
    """
    hot = heavy_keys(left, key, share)
    hot_right = right.join(F.broadcast(hot), right[right_key] == hot["_key"], "left_semi")
    hot_right = hot_right.select(F.col(right_key).alias("_rk"), *columns)
    marks = hot.select(F.col("_key").alias("_hk"), F.lit(True).alias("_hot"))
    marked = left.join(F.broadcast(marks), left[key] == F.col("_hk"), "left").drop("_hk")
    hot_rows = marked.where(F.col("_hot")).drop("_hot")
    rest = marked.where(F.col("_hot").isNull()).drop("_hot")
    a = hot_rows.join(F.broadcast(hot_right), hot_rows[key] == F.col("_rk"), how).drop("_rk")
    small = right.select(F.col(right_key).alias("_rk"), *columns)
    b = rest.join(small, rest[key] == F.col("_rk"), how).drop("_rk")
    return a.unionByName(b)
