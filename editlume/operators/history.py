"""History of changing attributes: checkpoints, patches, and validity rows folded from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART = ["entity", "period", "part"]


def group_set(text: Column) -> Column:
    """The sorted set of lower-case names in a group list of any notation; NULL stays NULL.

    Notations: serialised arrays (a:1:{i:0;s:3:"bot";}), bracketed quoted lists, and lists
    separated by commas, semicolons, bars or line ends. '(none)' and blanks are the empty set.
    """
    serial = text.rlike(r"^\s*a:\d+:\{")
    quoted = F.regexp_extract_all(text, F.lit('"([^"]*)"'), F.lit(1))
    plain = F.split(F.regexp_replace(text, r"""[\[\]'"]""", ""), r"[,;|\n]")
    names = F.transform(F.when(serial, quoted).otherwise(plain), lambda x: F.lower(F.trim(x)))
    kept = F.filter(names, lambda x: (x != "") & (x != "(none)"))
    return F.when(text.isNotNull(), F.array_sort(F.array_distinct(kept)))


def canonical_name(name: Column) -> Column:
    """A user name as the wiki compares it: no `User:` prefix, blanks for `_`, single inner blanks, first letter upper case."""
    flat = F.trim(F.regexp_replace(F.translate(name, "_", " "), r"\s+", " "))
    bare = F.trim(F.regexp_replace(flat, r"^(?i)user\s*:\s*", ""))
    return F.concat(F.upper(F.left(bare, F.lit(1))), F.substr(bare, F.lit(2)))


def checkpoint_delta(changes: DataFrame, period: str = "month", most: int = 500) -> tuple[DataFrame, DataFrame]:
    """Checkpoints (entity, period, part, state, fresh) and patches (entity, period, part, ts, id, added, removed).

    `changes` has entity, ts, id, state (an array, the full set after the change). A period of an
    entity has a part for every `most` changes. The checkpoint of a part is the state when it begins
    (`fresh`: there was none). A patch holds what a change adds to and removes from the state before.

    Order is looked at within one entity and period; across them only one row per part is ordered,
    so an entity with very many changes is spread over its periods, and no fold is longer than `most`.
    """
    within = Window.partitionBy("entity", "period").orderBy("ts", "id")
    dated = changes.withColumn("period", F.date_trunc(period, F.col("ts")).cast("timestamp_ntz"))
    dated = dated.withColumn("part", F.floor((F.row_number().over(within) - 1) / most).cast("int"))
    inside = Window.partitionBy(*PART).orderBy("ts", "id")
    ends = dated.groupBy(*PART).agg(F.max_by("state", F.struct("ts", "id")).alias("_end"))
    across = Window.partitionBy("entity").orderBy("period", "part")
    checkpoints = ends.withColumn("_before", F.lag("_end").over(across)).select(
        *PART, F.coalesce("_before", F.array().cast("array<string>")).alias("state"), F.col("_before").isNull().alias("fresh")
    )
    joined = dated.join(checkpoints.select(*PART, F.col("state").alias("_cp")), PART)
    prior = F.coalesce(F.lag("state").over(inside), F.col("_cp"))
    patches = joined.withColumn("_prior", prior).select(
        *PART, "ts", "id", F.array_except("state", "_prior").alias("added"), F.array_except("_prior", "state").alias("removed")
    )
    return checkpoints, patches


def reconstruct(checkpoints: DataFrame, patches: DataFrame) -> DataFrame:
    """Validity rows: entity, id, state, valid_from, valid_to, next_id (NULL in the open version).

    The patches of a part are folded forward over its checkpoint. A change that
    leaves the state as it was opens no version, except an entity's first. Ties in ts are ordered
    by id.
    """
    grouped = patches.groupBy(*PART).agg(F.array_sort(F.collect_list(F.struct("ts", "id", "added", "removed"))).alias("_p"))
    both = grouped.join(checkpoints, PART)
    start = F.struct(F.col("state").alias("state"), F.expr("cast(array() as array<struct<ts:timestamp_ntz,id:bigint,state:array<string>>>)").alias("versions"))

    def fold(acc: Column, patch: Column) -> Column:
        changed = (F.size(patch["added"]) + F.size(patch["removed"])) > 0
        state = F.array_sort(F.array_union(F.array_except(acc["state"], patch["removed"]), patch["added"]))
        opens = changed | (F.col("fresh") & (F.size(acc["versions"]) == 0))
        row = F.array(F.struct(patch["ts"].alias("ts"), patch["id"].alias("id"), state.alias("state")))
        return F.struct(state.alias("state"), F.when(opens, F.concat(acc["versions"], row)).otherwise(acc["versions"]).alias("versions"))

    folded = both.select(*PART, F.aggregate("_p", start, fold, lambda acc: acc["versions"]).alias("_v")).where(F.size("_v") > 0)
    across = Window.partitionBy("entity").orderBy("period", "part")
    nxt = folded.withColumn("_next", F.lead(F.element_at("_v", 1)).over(across))
    rows = nxt.select("entity", "_v", "_next", F.posexplode("_v").alias("_i", "_row"))
    following = F.coalesce(F.get("_v", F.col("_i") + 1), F.col("_next"))
    return rows.select(
        "entity",
        F.col("_row.id").alias("id"),
        F.col("_row.state").alias("state"),
        F.col("_row.ts").alias("valid_from"),
        following["ts"].alias("valid_to"),
        following["id"].alias("next_id"),
    )


def rights_changes(user_level: DataFrame, wiki_user: DataFrame) -> DataFrame:
    """entity, ts, id, state from rights log rows: one row per id, NULL sets and undated rows left out.

    Of rows repeated under one id the largest value of each column holds. Names compare as in
    `canonical_name` and are written as in wiki_user where it has them (of several spellings there
    the smallest).
    """
    once = (
        user_level.where("level_log_id is not null")
        .groupBy(F.col("level_log_id").alias("id"))
        .agg(F.max("level_username").alias("_n"), F.max("level_timestamp").alias("ts"), F.max("level_new").alias("_new"))
        .where("_n is not null and ts is not null and _new is not null")
        .select(canonical_name(F.col("_n")).alias("_c"), "ts", "id", group_set(F.col("_new")).alias("state"))
    )
    names = wiki_user.where("user_name is not null").groupBy(canonical_name(F.col("user_name")).alias("_c")).agg(F.min("user_name").alias("_user"))
    return once.join(names, "_c", "left").select(F.coalesce("_user", "_c").alias("entity"), "ts", "id", "state")
