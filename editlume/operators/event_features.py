"""Per-entity feature table from events: a store of cumulative day cells, as-of endpoint subtraction, recency."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from editlume.session import materialize


def clean_label(col: Column) -> Column:
    """Lower case, without outer white space, `_` for `-`."""
    return F.translate(F.regexp_replace(F.lower(col), r"^\s+|\s+$", ""), "-", "_")


def daily_cells(
    events: DataFrame, entity: str, event_id: str, ts: str, type_cols: Sequence[str], value: str | None = None
) -> DataFrame:
    """One row per entity, type and day: n, total, last (ts, id).

    Rows repeated under one `event_id` count once; of their differing values the largest non-NULL
    one holds, column by column. Rows without id, entity, or any type column belong to no cell.
    Events without a timestamp land in the cell of day NULL, where they count but have no recency.
    The first shuffle is by event id, so no entity's rows meet in one task before they are
    pre-aggregated.
    """
    once = (
        events.select(
            F.col(event_id).alias("_id"),
            F.col(entity).alias("_entity"),
            F.col(ts).alias("_ts"),
            *[clean_label(F.col(c)).alias(f"_t{i}") for i, c in enumerate(type_cols)],
            (F.col(value).cast("long") if value else F.lit(0).cast("long")).alias("_value"),
        )
        .where(F.col("_id").isNotNull())
        .groupBy("_id")
        .agg(*[F.max(c).alias(c) for c in ("_entity", "_ts", *[f"_t{i}" for i in range(len(type_cols))], "_value")])
    )
    types = [f"_t{i}" for i in range(len(type_cols))]
    for c in ("_entity", *types):
        once = once.where(F.col(c).isNotNull())
    return once.groupBy("_entity", *types, F.to_date("_ts").alias("day")).agg(
        F.count("*").alias("n"),
        F.sum(F.coalesce("_value", F.lit(0))).alias("total"),
        F.max(F.when(F.col("_ts").isNotNull(), F.struct(F.col("_ts"), F.col("_id")))).alias("last"),
    )


def cumulative_cells(cells: DataFrame, n_types: int) -> DataFrame:
    """The store: each cell with the running count and total of its entity and type at the end of its day (NULL in the cell of day NULL).

    A partition of the window is one entity and type, with at most one row per calendar day: its
    size is bounded by the length of the calendar whatever the number of events.
    """
    key = ["_entity", *[f"_t{i}" for i in range(n_types)]]
    w = Window.partitionBy(*key).orderBy(F.col("day").asc_nulls_last())
    before = w.rowsBetween(Window.unboundedPreceding, 0)
    dated = F.col("day").isNotNull()
    return cells.withColumn("cum_n", F.when(dated, F.sum("n").over(before))).withColumn("cum_total", F.when(dated, F.sum("total").over(before)))


def append_cells(store: DataFrame, cells: DataFrame, n_types: int) -> DataFrame:
    """The store after the `daily_cells` of further events (none of which it has seen): cells of one day add up, later ones are carried on."""
    key = ["_entity", *[f"_t{i}" for i in range(n_types)], "day"]
    both = store.drop("cum_n", "cum_total").unionByName(cells)
    return cumulative_cells(both.groupBy(*key).agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("last").alias("last")), n_types)


def window_features(
    events: DataFrame,
    entity: str,
    event_id: str,
    ts: str,
    type_cols: Sequence[str],
    as_of: date | None = None,
    windows: Sequence[int] = (30, 365),
    value: str | None = None,
    undated: bool = False,
) -> DataFrame:
    """One row per entity and type with dated events up to `as_of` (all, if None).

    n, total: up to the as-of day; n_<w>d, total_<w>d: within its last w days, each the difference
    of two endpoints of the cumulative cells; last_ts, last_id: the latest event by (ts, id).
    With as_of None windows end at the entity's and type's own last day. Empty input, empty result.
    undated: events without a timestamp count in n and total, in no window, and give a row (last_ts and
    last_id NULL) where nothing is dated; only with as_of None, as they are on no side of a day.
    """
    if undated and as_of is not None:
        raise ValueError("events without a timestamp are not before any day")
    store = materialize(cumulative_cells(daily_cells(events, entity, event_id, ts, type_cols, value), len(type_cols)), "feature-cells")
    return features_of(store, entity, type_cols, as_of, windows, undated)


def features_of(store: DataFrame, entity: str, type_cols: Sequence[str], as_of: date | None = None, windows: Sequence[int] = (30, 365), undated: bool = False) -> DataFrame:
    """`window_features`, read from the stored cumulative cells: their endpoints only, whatever the number of events."""
    cum = store.where("day is not null")
    key = ["_entity", *[f"_t{i}" for i in range(len(type_cols))]]
    if as_of is None:
        end: Column = F.max("day").over(Window.partitionBy(*key))
    else:
        end = F.lit(as_of)
        cum = cum.where(F.col("day") <= end)
    cum = cum.withColumn("_end", end)
    if undated:
        cum = cum.unionByName(store.where("day is null"), allowMissingColumns=True)
    rest = lambda c: F.coalesce(F.sum(F.when(F.col("day").isNull(), F.col(c))), F.lit(0))
    at = lambda c, upto: F.coalesce(F.max(F.when(F.col("day") <= upto, F.struct("day", c))).getField(c), F.lit(0))
    aggs = [
        at("cum_n", F.col("_end")).alias("n"),
        at("cum_total", F.col("_end")).alias("total"),
        F.max("last").alias("_last"),
        rest("n").alias("_n_undated"),
        rest("total").alias("_s_undated"),
    ]
    for w in windows:
        start = F.date_sub(F.col("_end"), w)
        aggs += [at("cum_n", start).alias(f"_n{w}"), at("cum_total", start).alias(f"_s{w}")]
    out = cum.groupBy(*key).agg(*aggs)
    cols = [F.col("_entity").alias(entity), *[F.col(f"_t{i}").alias(c) for i, c in enumerate(type_cols)]]
    cols += [(F.col("n") + F.col("_n_undated")).alias("n"), (F.col("total") + F.col("_s_undated")).alias("total")]
    for w in windows:
        cols += [(F.col("n") - F.col(f"_n{w}")).alias(f"n_{w}d"), (F.col("total") - F.col(f"_s{w}")).alias(f"total_{w}d")]
    return out.select(*cols, F.col("_last._ts").alias("last_ts"), F.col("_last._id").alias("last_id"))


def feature_table(long: DataFrame, entity: str, type_cols: Sequence[str]) -> DataFrame:
    """One row per entity: a map from 'type/action' to (n, total, last_ts), sorted by key.

    A map keeps hundreds of types in one column of bounded size (one entry per distinct type)
    where a pivot would need thousands of mostly empty columns.
    """
    name = F.concat_ws("/", *type_cols)
    entry = F.struct(name.alias("key"), F.struct("n", "total", "last_ts").alias("value"))
    return long.groupBy(entity).agg(
        F.sum("n").alias("n_events"),
        F.count("*").alias("n_types"),
        F.max("last_ts").alias("last_ts"),
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("features"),
    )
