"""Queries of the general data-preparation problems (1, 2, 4, 5, 6) and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editlume.operators.event_features import feature_table, window_features
from editlume.operators.history import checkpoint_delta, reconstruct, rights_changes
from editlume.operators.orphans import Reference, orphan_references, orphan_report
from editlume.operators.sessions import sessionize
from editlume.operators.skew import salted_aggregate
from editlume.session import materialize, table

AS_OF = date(2018, 1, 1)
SESSION_GAP_S = 3600
HEAVY_SHARE = 0.02


def _features(spark: SparkSession, sf: str, as_of: date | None = None, undated: bool = False) -> DataFrame:
    log = table(spark, sf, "logging").where("log_user > 0")
    return window_features(log, "log_user", "log_id", "log_timestamp", ["log_type", "log_action"], as_of, (30, 365), "log_new_flag", undated)


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return _features(spark, sf).where("n > 0").select("log_user", "log_type", "log_action", F.col("last_id").alias("last_log_id"))


def p1_window_features(spark: SparkSession, sf: str) -> DataFrame:
    return _features(spark, sf, AS_OF).withColumnRenamed("last_id", "last_log_id")


def p1_feature_table(spark: SparkSession, sf: str) -> DataFrame:
    return feature_table(_features(spark, sf, undated=True), "log_user", ["log_type", "log_action"])


def _sessions(spark: SparkSession, sf: str) -> DataFrame:
    rev = table(spark, sf, "revision").select("rev_id", "rev_user", "rev_timestamp").where("rev_user > 0")
    return sessionize(rev, "rev_user", "rev_id", "rev_timestamp", SESSION_GAP_S)


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return _sessions(spark, sf).select("rev_user", F.col("first_id").alias("first_rev_id"), F.col("last_id").alias("last_rev_id"))


def p2_sessions(spark: SparkSession, sf: str) -> DataFrame:
    return _sessions(spark, sf).select(
        "rev_user", F.col("first_id").alias("first_rev_id"), F.col("last_id").alias("last_rev_id"),
        F.col("start").alias("started_at"), F.col("end").alias("ended_at"), "duration_s", F.col("n_events").alias("n_revisions"),
    )


def _orphans(spark: SparkSession, sf: str) -> DataFrame:
    rev = table(spark, sf, "revision").select("rev_id", "rev_page", "rev_user", "rev_parent_id", "rev_timestamp", "loaded_at")
    refs = [
        Reference("rev_page", table(spark, sf, "page"), "page_id", "page"),
        Reference("rev_user", table(spark, sf, "wiki_user"), "user_id", "wiki_user"),
        Reference("rev_parent_id", None, "rev_id", "revision", (0,)),
    ]
    return orphan_references(rev, "rev_id", "rev_timestamp", "loaded_at", refs, table(spark, sf, "removed_row"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return _orphans(spark, sf).select("rev_id", "ref_field", "kind")


def p4_report(spark: SparkSession, sf: str) -> DataFrame:
    return orphan_report(_orphans(spark, sf))


def _versions(spark: SparkSession, sf: str) -> DataFrame:
    return reconstruct(*checkpoint_delta(rights_changes(table(spark, sf, "user_level"), table(spark, sf, "wiki_user"))))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return _versions(spark, sf).select(
        F.col("entity").alias("level_username"), F.col("id").alias("level_log_id"), F.coalesce("next_id", F.lit(0)).alias("next_log_id")
    )


def p5_history(spark: SparkSession, sf: str) -> DataFrame:
    return _versions(spark, sf).select(
        F.col("entity").alias("level_username"), F.col("id").alias("level_log_id"), F.concat_ws(",", "state").alias("rights"),
        F.col("valid_from"), F.col("valid_to"),
    )


def _both_keys(spark: SparkSession, sf: str, also: list | None = None) -> DataFrame:
    """Per value of rev_page and of rev_user; the table is read once, each row making one row a field."""
    rev = table(spark, sf, "revision").where("rev_id is not null")
    fields = [F.struct(F.lit(f).alias("ref_field"), F.col(f).alias("key_value")) for f in ("rev_page", "rev_user")]
    each = rev.select("rev_id", "rev_len", "rev_timestamp", F.inline(F.array(*fields, *(also or []))))
    return salted_aggregate(
        each,
        ["ref_field", "key_value"],
        "rev_id",
        {"_len": F.max("rev_len"), "_ts": F.max("rev_timestamp")},
        {
            "n_revisions": (F.count("*"), F.sum("n_revisions")),
            "total_len": (F.sum("_len"), F.sum("total_len")),
            "first_ts": (F.min("_ts"), F.min("first_ts")),
            "last_ts": (F.max("_ts"), F.max("last_ts")),
        },
    )


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    """The total of distinct revisions is one more key, ('', 0), the heaviest."""
    everything = F.struct(F.lit("").alias("ref_field"), F.lit(0).cast("long").alias("key_value"))
    keys = materialize(_both_keys(spark, sf, [everything]).select("ref_field", "key_value", "n_revisions"), "per-key")
    total = keys.where("ref_field = ''").select(F.col("n_revisions").alias("_total"))
    return keys.where("ref_field <> ''").crossJoin(F.broadcast(total)).where(F.col("n_revisions") >= HEAVY_SHARE * F.col("_total")).select("ref_field", "key_value")


def p6_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return _both_keys(spark, sf)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (p1_found, p1_window_features, p1_feature_table, p2_found, p2_sessions, p4_found, p4_report, p5_found, p5_history, p6_found, p6_per_key)
}

_LOG = """
log_once AS (
  SELECT log_id, max(log_user) AS u, max(log_timestamp) AS ts, max(log_new_flag) AS v,
         max(replace(regexp_replace(lower(log_type), '^\\s+|\\s+$', '', 'g'), '-', '_')) AS t,
         max(replace(regexp_replace(lower(log_action), '^\\s+|\\s+$', '', 'g'), '-', '_')) AS a
  FROM logging WHERE log_user > 0 AND log_id IS NOT NULL GROUP BY log_id),
log_dated AS (SELECT * FROM log_once WHERE ts IS NOT NULL AND t IS NOT NULL AND a IS NOT NULL)
"""

_SESSIONS = """
rev_once AS (SELECT rev_id, max(rev_user) AS u, max(rev_timestamp) AS ts FROM revision
             WHERE rev_user > 0 AND rev_id IS NOT NULL AND rev_timestamp IS NOT NULL GROUP BY rev_id),
marked AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) <= 3600000000 THEN 0 ELSE 1 END AS opens
           FROM rev_once WINDOW w AS (PARTITION BY u ORDER BY ts, rev_id)),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY u ORDER BY ts, rev_id) AS s FROM marked),
sessions AS (SELECT u AS rev_user, arg_min(rev_id, (ts, rev_id)) AS first_rev_id, arg_max(rev_id, (ts, rev_id)) AS last_rev_id,
                    min(ts) AS started_at, max(ts) AS ended_at, count(*) AS n_revisions
             FROM numbered GROUP BY u, s)
"""

_ORPHANS = """
rv AS (SELECT rev_id, max(rev_page) AS rev_page, max(rev_user) AS rev_user, max(rev_parent_id) AS rev_parent_id,
              max(rev_timestamp) AS ts, min(loaded_at) AS l FROM revision WHERE rev_id IS NOT NULL GROUP BY rev_id),
refs AS (SELECT rev_id, 'rev_page' AS ref_field, 'page' AS tab, rev_page AS k, ts, l FROM rv WHERE rev_page IS NOT NULL
         UNION ALL SELECT rev_id, 'rev_user', 'wiki_user', rev_user, ts, l FROM rv WHERE rev_user IS NOT NULL
         UNION ALL SELECT rev_id, 'rev_parent_id', 'revision', rev_parent_id, ts, l FROM rv WHERE rev_parent_id <> 0),
targets AS (SELECT 'page' AS tab, page_id AS k, min(loaded_at) AS tl FROM page GROUP BY page_id
            UNION ALL SELECT 'wiki_user', user_id, min(loaded_at) FROM wiki_user GROUP BY user_id
            UNION ALL SELECT 'revision', rev_id, l FROM rv),
judged AS (SELECT r.rev_id, r.ref_field, r.ts,
                  CASE WHEN t.k IS NULL THEN CASE WHEN EXISTS (SELECT 1 FROM removed_row x WHERE x.ref_table = r.tab AND x.row_key = r.k)
                                                  THEN 'deleted' ELSE 'missing' END
                       WHEN t.tl > r.l THEN 'late' END AS kind
           FROM refs r LEFT JOIN targets t ON t.tab = r.tab AND t.k = r.k)
"""

_RIGHTS = """
lv AS (SELECT level_log_id AS id, max(level_username) AS n, max(level_timestamp) AS ts, max(level_new) AS x
       FROM user_level WHERE level_log_id IS NOT NULL GROUP BY level_log_id),
named AS (SELECT *, trim(regexp_replace(trim(regexp_replace(replace(n, '_', ' '), '\\s+', ' ', 'g')), '^user\\s*:\\s*', '', 'i')) AS b
          FROM lv WHERE n IS NOT NULL AND ts IS NOT NULL AND x IS NOT NULL),
canon AS (SELECT id, ts, upper(substr(b, 1, 1)) || substr(b, 2) AS c, x FROM named),
wu AS (SELECT user_name, trim(regexp_replace(trim(regexp_replace(replace(user_name, '_', ' '), '\\s+', ' ', 'g')), '^user\\s*:\\s*', '', 'i')) AS b
       FROM wiki_user WHERE user_name IS NOT NULL),
names AS (SELECT upper(substr(b, 1, 1)) || substr(b, 2) AS c, min(user_name) AS user_name FROM wu GROUP BY 1),
items AS (SELECT id, CASE WHEN regexp_matches(x, '^\\s*a:[0-9]+:\\{') THEN regexp_extract_all(x, '"([^"]*)"', 1)
                          ELSE regexp_split_to_array(regexp_replace(x, '[\\[\\]''"]', '', 'g'), '[,;|\\n]') END AS l FROM canon),
sets AS (SELECT id, coalesce(string_agg(DISTINCT lower(trim(g)), ',' ORDER BY lower(trim(g)))
                             FILTER (WHERE trim(g) <> '' AND lower(trim(g)) <> '(none)'), '') AS s
         FROM (SELECT id, unnest(CASE WHEN len(l) = 0 THEN [''] ELSE l END) AS g FROM items) GROUP BY id),
entries AS (SELECT coalesce(user_name, canon.c) AS u, ts, id, s FROM canon JOIN sets USING (id) LEFT JOIN names ON names.c = canon.c),
opening AS (SELECT * FROM (SELECT *, lag(s) OVER (PARTITION BY u ORDER BY ts, id) AS p FROM entries) WHERE p IS NULL OR p <> s),
versions AS (SELECT u, id, s, ts, lead(id) OVER w AS next_id, lead(ts) OVER w AS next_ts FROM opening WINDOW w AS (PARTITION BY u ORDER BY ts, id))
"""

_KEYS = """
once AS (SELECT rev_id, max(rev_page) AS rev_page, max(rev_user) AS rev_user, max(rev_len) AS l, max(rev_timestamp) AS ts
         FROM revision WHERE rev_id IS NOT NULL GROUP BY rev_id),
keyed AS (SELECT 'rev_page' AS ref_field, rev_page AS key_value, l, ts FROM once WHERE rev_page IS NOT NULL
          UNION ALL SELECT 'rev_user', rev_user, l, ts FROM once WHERE rev_user IS NOT NULL)
"""

SQL: dict[str, str] = {
    "p1_found": f"""WITH {_LOG}
SELECT u AS log_user, t AS log_type, a AS log_action, arg_max(log_id, (ts, log_id)) AS last_log_id FROM log_dated GROUP BY u, t, a""",
    "p1_window_features": f"""WITH {_LOG}
SELECT u AS log_user, t AS log_type, a AS log_action, count(*) AS n, sum(coalesce(v, 0))::BIGINT AS total,
       count(*) FILTER (WHERE ts::DATE > DATE '2018-01-01' - 30) AS n_30d,
       coalesce(sum(v) FILTER (WHERE ts::DATE > DATE '2018-01-01' - 30), 0)::BIGINT AS total_30d,
       count(*) FILTER (WHERE ts::DATE > DATE '2018-01-01' - 365) AS n_365d,
       coalesce(sum(v) FILTER (WHERE ts::DATE > DATE '2018-01-01' - 365), 0)::BIGINT AS total_365d,
       max(ts) AS last_ts, arg_max(log_id, (ts, log_id)) AS last_log_id
FROM log_dated WHERE ts::DATE <= DATE '2018-01-01' GROUP BY u, t, a""",
    "p2_found": f"WITH {_SESSIONS} SELECT rev_user, first_rev_id, last_rev_id FROM sessions",
    "p2_sessions": f"""WITH {_SESSIONS}
SELECT rev_user, first_rev_id, last_rev_id, started_at, ended_at,
       (epoch_us(ended_at) - epoch_us(started_at)) // 1000000 AS duration_s, n_revisions FROM sessions""",
    "p4_found": f"WITH {_ORPHANS} SELECT rev_id, ref_field, kind FROM judged WHERE kind IS NOT NULL",
    "p4_report": f"""WITH {_ORPHANS} SELECT ref_field, kind, strftime(ts, '%Y-%m') AS period, count(*) AS n_refs
FROM judged WHERE kind IS NOT NULL GROUP BY ALL""",
    "p5_found": f"WITH {_RIGHTS} SELECT u AS level_username, id AS level_log_id, coalesce(next_id, 0) AS next_log_id FROM versions",
    "p5_history": f"WITH {_RIGHTS} SELECT u AS level_username, id AS level_log_id, s AS rights, ts AS valid_from, next_ts AS valid_to FROM versions",
    "p6_found": f"""WITH {_KEYS} SELECT ref_field, key_value FROM keyed GROUP BY ALL
HAVING count(*) >= 0.02 * (SELECT count(*) FROM once)""",
    "p6_per_key": f"""WITH {_KEYS} SELECT ref_field, key_value, count(*) AS n_revisions, sum(l)::BIGINT AS total_len,
min(ts) AS first_ts, max(ts) AS last_ts FROM keyed GROUP BY ref_field, key_value""",
}
