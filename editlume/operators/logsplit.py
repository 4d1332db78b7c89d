"""One log relation into four: logging, block, user_new, user_level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from editlume.functions import logitem as L


def split_log(items: DataFrame, namespaces: dict[str, int]) -> dict[str, DataFrame]:
    """Four frames over the same parsed entries.

    items: id, timestamp (zone-less), user_id, username, comment, type, action, title, params. NULLs
    become '' in text columns and -1 in user ids. Write `items` to a table first when it comes from
    XML: each frame scans it once.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    user = F.coalesce(F.col("user_id"), F.lit(L.UNKNOWN_USER)).cast("long")
    new, old = L.flagged_ids(L.is_review(F.col("type"), F.col("action")), F.col("params"))
    logging = items.select(
        F.col("id").alias("log_id"), F.col("type").alias("log_type"), F.col("action").alias("log_action"),
        F.col("timestamp").alias("log_timestamp"), user.alias("log_user"), text("username").alias("log_username"),
        L.title_namespace(F.col("title"), namespaces).alias("log_namespace"), text("title").alias("log_title"),
        text("comment").alias("log_comment"), text("params").alias("log_params"), new.alias("log_new_flag"), old.alias("log_old_flag"),
    )
    target, target_ip = L.block_target(F.col("title"))
    block = items.where(L.is_block(F.col("type"), F.col("action"))).select(
        F.col("id").alias("block_id"), F.col("action").alias("block_action"), user.alias("block_user"), F.col("timestamp").alias("block_timestamp"),
        target.alias("block_target"), target_ip.alias("block_ip"), L.block_duration(F.col("params"), F.col("timestamp")).alias("block_duration"),
    )
    user_new = items.where(L.is_new_user(F.col("type"), F.col("action"))).select(
        F.col("id").alias("user_log_id"), user.alias("user_id"), text("username").alias("user_name"),
        F.col("timestamp").alias("user_timestamp"), F.col("action").alias("user_action"),
    )
    name, before, after = L.rights_change(F.col("title"), F.col("params"), F.col("comment"))
    level = items.where(L.is_rights(F.col("type"), F.col("action"))).select(
        F.col("id").alias("level_log_id"), user.alias("level_granter_id"), name.alias("level_username"),
        F.col("timestamp").alias("level_timestamp"), before.alias("level_old"), after.alias("level_new"),
    )
    return {"logging": logging, "block": block, "user_new": user_new, "user_level": level}
