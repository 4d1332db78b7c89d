"""Sessions split by inactivity gaps, by pointer doubling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from editlume.session import materialize


def link_predecessors(events: DataFrame, gap_seconds: int) -> DataFrame:
    """Adds `pred`: the id of the event before, in (ts, id) order, if at most `gap_seconds` earlier; else NULL.

    Expects entity, ts, id. The order is looked at one entity and gap-long slot of time at a time,
    so an entity with a third of all rows is spread over its slots: a predecessor within the gap
    lies in the same slot or in the one before, whose last event is joined in.
    """
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    slotted = events.withColumn("_us", micros).withColumn("_slot", F.floor(F.col("_us") / F.lit(gap_seconds * 1_000_000)).cast("long"))
    w = Window.partitionBy("entity", "_slot").orderBy("ts", "id")
    inside = slotted.withColumn("_p", F.lag(F.struct("_us", "id")).over(w))
    ends = slotted.groupBy("entity", "_slot").agg(F.max(F.struct("_us", "id")).alias("_e"))
    before = ends.select("entity", (F.col("_slot") + 1).alias("_slot"), F.col("_e"))
    first = inside.where(F.col("_p").isNull()).join(before, ["entity", "_slot"], "left")
    rest = inside.where(F.col("_p").isNotNull()).withColumn("_e", F.lit(None).cast(first.schema["_e"].dataType))
    both = first.unionByName(rest).withColumn("_q", F.coalesce("_p", "_e"))
    near = F.col("_us") - F.col("_q._us") <= F.lit(gap_seconds * 1_000_000)
    return both.select("entity", "id", "ts", F.when(near, F.col("_q.id")).alias("pred"))


def sessionize(events: DataFrame, entity: str, event_id: str, ts: str, gap_seconds: int = 3600) -> DataFrame:
    """One row per session: entity, first_id, last_id, start, end, duration_s, n_events.

    An event opens a session if more than `gap_seconds` have passed since the entity's event
    before it, in (ts, id) order. Rows repeated under one id count once (their largest entity and
    ts hold); rows with a NULL entity, id or ts are in no session. Ties in ts are ordered by id.

    Every event points to its predecessor within the gap, a first one to itself. Each round
    replaces the pointer by the pointer's pointer, halving the distance to the root; only rows not
    yet at their root take part, so n events in the longest session need log2(n) + 1 rounds. Rows
    that have arrived serve as targets as long as they are pointed at. Each round is written to the
    shared folder, so a lost executor costs one round at most; the tables are the session's scratch.
    """
    once = (
        events.select(F.col(entity).alias("entity"), F.col(event_id).alias("id"), F.col(ts).alias("ts"))
        .where("entity is not null and id is not null and ts is not null")
        .groupBy("id")
        .agg(F.max("entity").alias("entity"), F.max("ts").alias("ts"))
    )
    nodes = materialize(link_predecessors(once, gap_seconds), "session-links")
    active = nodes.where("pred is not null").select("id", F.col("pred").alias("ptr"), F.lit(False).alias("done"))
    targets = active
    roots: DataFrame | None = None
    while True:
        t = targets.select(F.col("id").alias("_t"), F.col("ptr").alias("_next"), F.col("done").alias("_arrived"))
        # roots have no row among the targets: a pointer without a match has arrived, as has one to a row that has
        moved = active.join(t, active["ptr"] == t["_t"], "left").select(
            "id", F.coalesce("_next", "ptr").alias("ptr"), (F.col("_next").isNull() | F.col("_arrived")).alias("done"), F.lit(True).alias("own")
        )
        # a row nobody points at now is pointed at by nobody later, as pointers only move towards the root
        asked = t.where("_arrived").join(active.select("ptr"), F.col("_t") == F.col("ptr"), "left_semi")
        kept = asked.select(F.col("_t").alias("id"), F.col("_next").alias("ptr"), F.col("_arrived").alias("done"), F.lit(False).alias("own"))
        step = materialize(moved.unionByName(kept), "session-step")
        arrived = step.where("own and done").select("id", "ptr")
        roots = arrived if roots is None else roots.unionByName(arrived)
        targets, active = step.select("id", "ptr", "done"), step.where("not done").select("id", "ptr", "done")
        if active.isEmpty():
            break
    labelled = nodes.join(roots.withColumnRenamed("ptr", "root"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    return summarize(labelled, entity)


def summarize(labelled: DataFrame, entity: str) -> DataFrame:
    return labelled.groupBy(F.col("entity").alias(entity), "root").agg(
        F.min(F.struct("ts", "id")).alias("_a"), F.max(F.struct("ts", "id")).alias("_b"), F.count("*").alias("n_events")
    ).select(
        entity,
        F.col("_a.id").alias("first_id"),
        F.col("_b.id").alias("last_id"),
        F.col("_a.ts").alias("start"),
        F.col("_b.ts").alias("end"),
        F.expr("timestampdiff(SECOND, _a.ts, _b.ts)").alias("duration_s"),
        "n_events",
    )
