"""Editors and edits per period, newcomers, groups, inter-edit times."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from editlume.operators.pages import first_revisions, moment, within

ACTIVE, VERY_ACTIVE = 5, 100


def members(user_groups: DataFrame, group: str) -> DataFrame:
    return user_groups.where(F.col("ug_group") == group).select("ug_user").distinct()


def month_revisions(revision: DataFrame, low: datetime, up: datetime) -> DataFrame:
    """Registered users' revisions in [low, up)."""
    return revision.where((F.col("rev_user") > 0) & within("rev_timestamp", low, up)).select("rev_id", "rev_page", "rev_user", "rev_timestamp")


def without_bots(revisions: DataFrame, user_groups: DataFrame) -> DataFrame:
    bots = members(user_groups, "bot")
    return revisions.join(bots, revisions["rev_user"] == bots["ug_user"], "left_anti")


def editor_counts(human: DataFrame, active: int = ACTIVE, very_active: int = VERY_ACTIVE) -> DataFrame:
    """Users with an edit, with more than `active`, with more than `very_active` edits: one two-level aggregate."""
    per_user = human.groupBy("rev_user").agg(F.count("*").alias("n"))
    return per_user.agg(
        F.count("*").alias("month_users"), F.count_if(F.col("n") > active).alias("month_active_users"), F.count_if(F.col("n") > very_active).alias("month_very_active_users")
    )


def sysop_count(human: DataFrame, user_groups: DataFrame) -> DataFrame:
    ops = members(user_groups, "sysop")
    return human.join(ops, human["rev_user"] == ops["ug_user"], "left_semi").agg(F.count_distinct("rev_user").alias("month_sysops"))


def edit_counts(revision: DataFrame, user_groups: DataFrame, low: datetime, up: datetime) -> DataFrame:
    """All, registered, and registered without bots, in one pass over per-user counts."""
    bots = members(user_groups, "bot").withColumn("_bot", F.lit(True))
    per_user = revision.where(within("rev_timestamp", low, up)).groupBy("rev_user").agg(F.count("*").alias("n"))
    marked = per_user.join(bots, per_user["rev_user"] == bots["ug_user"], "left")
    reg = F.col("rev_user") > 0
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return marked.agg(
        total(F.col("n")).alias("month_edits"), total(F.when(reg, F.col("n"))).alias("month_edits_reg"),
        total(F.when(reg & F.col("_bot").isNull(), F.col("n"))).alias("month_edits_nobots"),
    )


def monthly_activity(revision: DataFrame, user_groups: DataFrame, active: int = ACTIVE, very_active: int = VERY_ACTIVE) -> DataFrame:
    """All user metrics for every month at once: one row per month."""
    ug = user_groups.groupBy("ug_user").agg(F.max((F.col("ug_group") == "bot").cast("int")).alias("_bot"), F.max((F.col("ug_group") == "sysop").cast("int")).alias("_op"))
    per_user = revision.groupBy(F.date_format("rev_timestamp", "yyyy-MM").alias("month"), "rev_user").agg(F.count("*").alias("n"))
    m = per_user.join(ug, per_user["rev_user"] == ug["ug_user"], "left")
    reg = F.col("rev_user") > 0
    human = reg & (F.coalesce("_bot", F.lit(0)) == 0)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return m.where("month is not null").groupBy("month").agg(
        total(F.col("n")).alias("month_edits"), total(F.when(reg, F.col("n"))).alias("month_edits_reg"), total(F.when(human, F.col("n"))).alias("month_edits_nobots"),
        F.count_if(human).alias("month_users"), F.count_if(human & (F.col("n") > active)).alias("month_active_users"),
        F.count_if(human & (F.col("n") > very_active)).alias("month_very_active_users"), F.count_if(human & (F.col("_op") == 1)).alias("month_sysops"),
        (F.count_if(reg) - F.count_if(human & (F.col("n") > active))).alias("other_contributors"),
    )


def weekly_newcomers(revision: DataFrame, user_groups: DataFrame, since_year: int, before: datetime, registered_only: bool = False) -> DataFrame:
    """New editors per Monday-based week, bots left out: week (Monday), year_week, new_editors."""
    from editlume.functions.text import year_week

    first = first_revisions(revision, "rev_user")
    if registered_only:
        first = first.where("rev_user > 0")
    kept = without_bots(first, user_groups).where((F.year("rev_timestamp") >= since_year) & (F.col("rev_timestamp") < moment(before)))
    week = F.date_trunc("week", "rev_timestamp").cast("date")
    return kept.groupBy(week.alias("week"), year_week(F.col("rev_timestamp")).alias("year_week")).agg(F.count("*").alias("new_editors"))


def group_label(users: DataFrame, user_groups: DataFrame, default: str = "registered") -> DataFrame:
    """Users with the sorted list of their groups, `default` where there are none."""
    g = user_groups.groupBy("ug_user").agg(F.array_join(F.array_sort(F.collect_set("ug_group")), ",").alias("_g"))
    return users.join(g, users["rev_user"] == g["ug_user"], "left").select("rev_user", F.coalesce("_g", F.lit(default)).alias("user_group"))


def inter_edit_seconds(revision: DataFrame, key: str) -> DataFrame:
    """Seconds from each revision to the key's next one, revisions of one (key, timestamp) taken as one.

    The order is kept per key and month, months are chained by their first revisions, so a key
    with very many revisions is spread over its months.
    """
    once = revision.where(F.col(key).isNotNull() & F.col("rev_timestamp").isNotNull()).groupBy(key, "rev_timestamp").agg(F.min("rev_id").alias("rev_id"))
    dated = once.withColumn("_m", F.date_trunc("month", "rev_timestamp"))
    inside = Window.partitionBy(key, "_m").orderBy("rev_timestamp")
    firsts = dated.groupBy(key, "_m").agg(F.min("rev_timestamp").alias("_first"))
    after = firsts.withColumn("_then", F.lead("_first").over(Window.partitionBy(key).orderBy("_m"))).select(F.col(key).alias("_k"), F.col("_m").alias("_mm"), "_then")
    nxt = dated.withColumn("_next", F.lead("rev_timestamp").over(inside))
    joined = nxt.join(after, (nxt[key] == after["_k"]) & (nxt["_m"] == after["_mm"]))
    return joined.select(key, "rev_id", F.timestamp_diff("SECOND", F.col("rev_timestamp"), F.coalesce("_next", "_then")).alias("gap_s"))
