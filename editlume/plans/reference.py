"""Registered queries over the wiki tables, and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editlume.functions import logitem as L
from editlume.functions import revision as R
from editlume.functions.patterns import FEATURED_ARTICLE, FEATURED_LIST, GOOD_ARTICLE
from editlume.functions.text import human_size, year_week
from editlume.operators import countries, editors, pages, stats
from editlume.operators.logsplit import split_log
from editlume.operators.skew import heavy_join
from editlume.session import table

# the period of the "month" metrics: a year, as the test wiki has few edits in a month
LOW, UP = datetime(2014, 1, 1), datetime(2015, 1, 1)
_P = "'2014-01-01'"
_Q = "'2015-01-01'"
WIKIS = ("enwiki", "dewiki", "eswiki", "frwiki")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


BEFORE_END = f"rev_timestamp < timestamp_ntz{_Q}"
IN_PERIOD = f"rev_timestamp >= timestamp_ntz{_P} and {BEFORE_END}"


def revision(spark: SparkSession, sf: str, where: str | None = None) -> DataFrame:
    """One row per rev_id; of repeated rows the largest value of each column holds (one shuffle, partial aggregates).

    Only the columns a query uses are read and carried: unused aggregates are pruned. Repeated rows
    carry the same page, user and time, so `where` on these filters the rows before the fold and reaches the scan.
    """
    cols = ("rev_page", "rev_user", "rev_timestamp", "rev_len", "rev_parent_id", "rev_is_redirect", "rev_minor_edit", "rev_fa", "rev_flist", "rev_ga")
    rows = table(spark, sf, "revision").where("rev_id is not null")
    return (rows if where is None else rows.where(where)).groupBy("rev_id").agg(*[F.max(c).alias(c) for c in cols])


_REV = """
rev AS (SELECT rev_id, max(rev_page) AS rev_page, max(rev_user) AS rev_user, max(rev_timestamp) AS rev_timestamp, max(rev_len) AS rev_len,
               max(rev_parent_id) AS rev_parent_id, max(rev_is_redirect) AS rev_is_redirect, max(rev_minor_edit) AS rev_minor_edit,
               max(rev_fa) AS rev_fa, max(rev_flist) AS rev_flist, max(rev_ga) AS rev_ga
        FROM revision WHERE rev_id IS NOT NULL GROUP BY rev_id)
"""
_ARTICLES = """
arts AS (SELECT page_id, arg_max(page_title, loaded_at) AS page_title FROM page GROUP BY page_id HAVING arg_max(page_namespace, loaded_at) = 0)
"""
_FIRST = """
first AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY rev_page ORDER BY rev_timestamp, rev_id) AS rn
          FROM rev WHERE rev_page IS NOT NULL) WHERE rn = 1),
fa AS (SELECT first.*, page_id, page_title FROM first JOIN arts ON rev_page = page_id)
"""
_BOTS = "bots AS (SELECT DISTINCT ug_user FROM user_groups WHERE ug_group = 'bot')"
_MONTH = f"""
month AS (SELECT rev_id, rev_page, rev_user, rev_timestamp FROM rev WHERE rev_user > 0 AND rev_timestamp >= {_P} AND rev_timestamp < {_Q}),
human AS (SELECT * FROM month WHERE rev_user NOT IN (SELECT ug_user FROM bots))
"""


# --- enrichment of texts -------------------------------------------------------------------------


@query("""SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT AS rev_len, sha256(coalesce(text, '')) AS rev_hash FROM documents""")
def rev_text_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", R.byte_length(F.col("text")).alias("rev_len"), R.text_digest(F.col("text")).alias("rev_hash"))


@query("""SELECT sha256(text) AS rev_hash, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1""")
def dup_revision_hash(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").where("text is not null")
    return d.groupBy(R.text_digest(F.col("text")).alias("rev_hash")).agg(F.count("*").alias("n")).where("n > 1")


@query("""SELECT rev_id, max((sha256(coalesce(text, '')) = lower(rev_hash))::INT) AS matches
FROM (SELECT rev_id, max(text) AS text FROM revision WHERE rev_id IS NOT NULL GROUP BY rev_id) JOIN revision_hash USING (rev_id) GROUP BY rev_id""")
def stored_hash_check(spark: SparkSession, sf: str) -> DataFrame:
    """Whether any stored digest of a revision is that of its text."""
    own = table(spark, sf, "revision").where("rev_id is not null").groupBy("rev_id").agg(R.text_digest(F.max("text")).alias("own"))
    stored = table(spark, sf, "revision_hash").select("rev_id", F.lower("rev_hash").alias("rev_hash"))
    return own.join(stored, "rev_id").groupBy("rev_id").agg(F.max((F.col("own") == F.col("rev_hash")).cast("int")).alias("matches"))


# the status templates do not occur in the test texts: each is also tried on texts that hold one
_SAMPLES = [
    ("enwiki", 0, "{{Featured article}} x"), ("enwiki", 1, "{{featured Article}}"), ("enwiki", 0, "a {{Featured list}}"), ("enwiki", 0, "{{good article}}"),
    ("dewiki", 0, "{{Exzellent|14. Juni 2008|111222333}}"), ("dewiki", 0, "{{Informativ}}"), ("dewiki", 0, "{{lesenswert|x|12}}"),
    ("eswiki", 0, "{{Artículo destacado}}"), ("eswiki", 0, "{{artículo bueno}}"), ("frwiki", 0, "{{Bon article|date=x}}"),
    ("frwiki", 0, "{{Article de qualité|oldid=1}}"), ("enwiki", 0, "#redirect [[X]]"), ("dewiki", 0, "#REDIRECTION"), ("frwiki", 0, " #REDIRECT"),
    ("enwiki", 0, None), ("enwiki", 0, ""), ("enwiki", None, "{{Featured article}}"),
]


def _quoted(x: object) -> str:
    return "NULL" if x is None else str(x) if isinstance(x, int) else "'" + str(x).replace("'", "''") + "'"


def _flag_sql() -> str:
    def found(patterns: dict) -> str:
        arms = " ".join(f"WHEN '{w}' THEN regexp_matches(text, {_quoted(patterns[w])})" for w in WIKIS if patterns.get(w))
        return f"coalesce((ns = 0 AND CASE wiki {arms} ELSE false END), false)::TINYINT"

    values = ", ".join("(" + ", ".join(map(_quoted, r)) + ")" for r in _SAMPLES)
    return f"""WITH t(wiki, ns, text) AS (VALUES {values} UNION ALL SELECT 'enwiki', 0, text FROM documents)
SELECT wiki, ns::INT AS ns, text, coalesce((upper(substr(text, 1, 9)) = '#REDIRECT'), false)::TINYINT AS rev_is_redirect,
       {found(FEATURED_ARTICLE)} AS rev_fa, {found(FEATURED_LIST)} AS rev_flist, {found(GOOD_ARTICLE)} AS rev_ga FROM t"""


@query(_flag_sql())
def redirect_fa_ga_flags(spark: SparkSession, sf: str) -> DataFrame:
    given = spark.createDataFrame(_SAMPLES, "wiki string, ns int, text string")
    docs = table(spark, sf, "documents").select(F.lit("enwiki").alias("wiki"), F.lit(0).alias("ns"), "text")
    out = None
    for w in WIKIS:
        part = given.where(F.col("wiki") == w)
        part = part.unionByName(docs) if w == "enwiki" else part
        part = part.select("wiki", "ns", "text", *[c.alias(n) for n, c in R.status_flags(F.col("text"), F.col("ns"), w).items()])
        out = part if out is None else out.unionByName(part)
    return out


@query("""SELECT log_id, log_ip, (p[1]::BIGINT * 16777216 + p[2]::BIGINT * 65536 + p[3]::BIGINT * 256 + p[4]::BIGINT) AS ip_v4 FROM
(SELECT log_id, log_ip, string_split(log_ip, '.') AS p FROM (SELECT DISTINCT log_id,
 (log_id % 256) || '.' || (log_id * 7 % 256) || '.' || (log_id * 13 % 256) || '.' || (log_id * 29 % 256) AS log_ip FROM logging))""")
def ipv4_to_int(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("log_id")
    ip = F.concat_ws(".", *[F.pmod(i * k, F.lit(256)).cast("string") for k in (1, 7, 13, 29)])
    d = table(spark, sf, "logging").select("log_id").distinct().select("log_id", ip.alias("log_ip"))
    return d.select("log_id", "log_ip", R.anonymous_ip(F.col("log_ip")).alias("ip_v4"))


@query("""SELECT doc_id, unnest(regexp_extract_all(text, 'href="([^"]*)"', 1)) AS href FROM documents""")
def href_extract(spark: SparkSession, sf: str) -> DataFrame:
    from editlume.functions.text import hrefs

    return table(spark, sf, "documents").select("doc_id", F.explode(hrefs(F.col("text"))).alias("href"))


@query(f"""WITH {_REV} SELECT rev_id, lag(rev_id) OVER (PARTITION BY rev_page ORDER BY rev_id) AS previous_rev FROM rev WHERE rev_page IS NOT NULL""")
def parent_revision(spark: SparkSession, sf: str) -> DataFrame:
    """The revision before in the page's own order, from flat rows: per page and block of ids, blocks chained by their ends."""
    block = F.floor(F.col("rev_id") / 10_000)
    r = revision(spark, sf).where("rev_page is not null").select("rev_page", "rev_id").withColumn("_b", block)
    from pyspark.sql import Window

    last = r.groupBy("rev_page", "_b").agg(F.max("rev_id").alias("_last"))
    chain = last.withColumn("_before", F.lag("_last").over(Window.partitionBy("rev_page").orderBy("_b"))).drop("_last")
    inside = r.withColumn("_p", F.lag("rev_id").over(Window.partitionBy("rev_page", "_b").orderBy("rev_id")))
    return inside.join(chain, ["rev_page", "_b"]).select("rev_id", F.coalesce("_p", "_before").alias("previous_rev"))


@query("""SELECT log_id, CASE WHEN log_id % 5 = 0 THEN 0 WHEN log_user > 0 THEN log_user WHEN log_username IS NOT NULL THEN -2 ELSE -1 END AS editor
FROM (SELECT log_id, max(log_user) AS log_user, max(log_username) AS log_username FROM logging GROUP BY log_id)""")
def user_sentinels(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "logging").groupBy("log_id").agg(F.max("log_user").alias("u"), F.max("log_username").alias("n"))
    ip = F.when(F.col("log_id") % 5 == 0, F.lit("1.2.3.4"))
    return d.select("log_id", R.editor_id(ip, F.col("u"), F.col("n")).alias("editor"))


# --- log entries ----------------------------------------------------------------------------------


def _log(spark: SparkSession, sf: str) -> DataFrame:
    cols = ("log_timestamp", "log_user", "log_username", "log_comment", "log_type", "log_action", "log_title", "log_params")
    once = table(spark, sf, "logging").where("log_id is not null").groupBy("log_id").agg(*[F.max(c).alias(c) for c in cols])
    return once.select(
        F.col("log_id").alias("id"), F.col("log_timestamp").alias("timestamp"), F.col("log_user").alias("user_id"), F.col("log_username").alias("username"),
        F.col("log_comment").alias("comment"), F.col("log_type").alias("type"), F.col("log_action").alias("action"), F.col("log_title").alias("title"), F.col("log_params").alias("params"),
    )


def _namespaces(spark: SparkSession, sf: str) -> dict[str, int]:
    return {r["name"]: r["code"] for r in table(spark, sf, "wiki_namespace").collect()}


_LOG = """
lg AS (SELECT log_id AS id, max(log_timestamp) AS ts, coalesce(max(log_user), -1) AS u, coalesce(max(log_username), '') AS n, coalesce(max(log_comment), '') AS c,
              max(log_type) AS ty, max(log_action) AS ac, max(log_title) AS ti, max(log_params) AS pa,
              replace(lower(trim(max(log_type))), '_', '-') AS t, replace(lower(trim(max(log_action))), '_', '-') AS a
       FROM logging WHERE log_id IS NOT NULL GROUP BY log_id)
"""


@query(f"""WITH {_LOG}, parts AS (SELECT *, string_split(ti, ':') AS p, string_split(pa, chr(10)) AS l,
  t = 'review' AND a IN ('approve', 'approve-a', 'unapprove', 'approve-ia', 'approve-i') AS rv FROM lg)
SELECT id AS log_id, ty AS log_type, ac AS log_action, ts AS log_timestamp, u AS log_user, n AS log_username,
  (CASE WHEN coalesce(ti, '') = '' THEN -1000 WHEN len(p) = 2 THEN coalesce((SELECT max(code) FROM wiki_namespace w WHERE w.name = p[1]), 0) ELSE 0 END)::INT AS log_namespace,
  coalesce(ti, '') AS log_title, c AS log_comment, coalesce(pa, '') AS log_params,
  CASE WHEN rv AND len(l) BETWEEN 1 AND 3 THEN coalesce(TRY_CAST(l[1] AS BIGINT), 0) ELSE 0 END AS log_new_flag,
  CASE WHEN rv AND len(l) BETWEEN 2 AND 3 THEN coalesce(TRY_CAST(l[2] AS BIGINT), 0) ELSE 0 END AS log_old_flag FROM parts""")
def logging_table(spark: SparkSession, sf: str) -> DataFrame:
    return split_log(_log(spark, sf), _namespaces(spark, sf))["logging"]


@query(f"""WITH {_LOG}, b AS (SELECT *, string_split(ti, ':') AS p, lower(trim(string_split(pa, chr(10))[1])) AS f FROM lg
  WHERE t = 'block' AND a IN ('block', 'unblock', 'reblock'))
SELECT id AS block_id, ac AS block_action, u AS block_user, ts AS block_timestamp,
  CASE WHEN len(p) = 2 AND NOT regexp_matches(p[2], '^[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+$') THEN p[2] ELSE '' END AS block_target, CAST(NULL AS BIGINT) AS block_ip,
  (CASE WHEN regexp_matches(f, '^(infinite|indefinite|infinity)') THEN 86400000000000.0
        ELSE coalesce(TRY_CAST(regexp_extract(f, '^([0-9]+)\\s*[a-z]', 1) AS DOUBLE) * CASE regexp_extract(f, '^[0-9]+\\s*(sec|min|h|d|week|month|year)', 1)
          WHEN 'sec' THEN 1 WHEN 'min' THEN 60 WHEN 'h' THEN 3600 WHEN 'd' THEN 86400 WHEN 'week' THEN 604800 WHEN 'month' THEN 2592000 WHEN 'year' THEN 31557600 END, 0.0) END)::DECIMAL(15,1) AS block_duration
FROM b""")
def block_table(spark: SparkSession, sf: str) -> DataFrame:
    return split_log(_log(spark, sf), _namespaces(spark, sf))["block"]


@query(f"""WITH {_LOG} SELECT id AS user_log_id, u AS user_id, n AS user_name, ts AS user_timestamp, ac AS user_action FROM lg
WHERE t = 'newusers' AND a IN ('newusers', 'create', 'create2', 'autocreate', 'byemail')""")
def user_new_table(spark: SparkSession, sf: str) -> DataFrame:
    return split_log(_log(spark, sf), _namespaces(spark, sf))["user_new"]


@query(f"""WITH {_LOG}, r AS (SELECT *, string_split(pa, chr(10)) AS l FROM lg WHERE t = 'rights' AND a = 'rights')
SELECT id AS level_log_id, u AS level_granter_id, coalesce(string_split(ti, ':')[2], '') AS level_username, ts AS level_timestamp,
  CASE WHEN coalesce(pa, '') <> '' AND len(l) > 1 THEN l[1] ELSE '' END AS level_old,
  CASE WHEN coalesce(pa, '') = '' THEN c WHEN len(l) > 1 THEN l[2] ELSE l[1] END AS level_new FROM r""")
def user_level_table(spark: SparkSession, sf: str) -> DataFrame:
    return split_log(_log(spark, sf), _namespaces(spark, sf))["user_level"]


# --- pages ----------------------------------------------------------------------------------------


@query(f"WITH {_ARTICLES} SELECT page_id, page_title FROM arts")
def articles(spark: SparkSession, sf: str) -> DataFrame:
    return pages.articles(table(spark, sf, "page"))


_COLS = "rev_id, rev_page, rev_user, rev_timestamp, rev_len, rev_is_redirect"


@query(f"WITH {_REV}, {_ARTICLES}, {_FIRST} SELECT {_COLS} FROM first")
def page_min_ts(spark: SparkSession, sf: str) -> DataFrame:
    return pages.first_revisions(revision(spark, sf), "rev_page")


@query(f"WITH {_REV}, {_ARTICLES}, {_FIRST} SELECT {_COLS}, page_id, page_title FROM fa")
def page_min_articles(spark: SparkSession, sf: str) -> DataFrame:
    return pages.first_article_revisions(revision(spark, sf), table(spark, sf, "page"))


@query(f"""WITH {_REV} SELECT {_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY rev_user ORDER BY rev_timestamp, rev_id) AS rn
FROM rev WHERE rev_user IS NOT NULL) WHERE rn = 1""")
def user_min_ts(spark: SparkSession, sf: str) -> DataFrame:
    return pages.first_revisions(revision(spark, sf), "rev_user")


def _article_counts(spark: SparkSession, sf: str) -> DataFrame:
    return pages.article_counts(pages.first_article_revisions(revision(spark, sf), table(spark, sf, "page")), LOW, UP)


def _one(name: str, source: Callable[[SparkSession, str], DataFrame], sql: str) -> None:
    """A query of one column of a one-row metric frame; the other columns are pruned from its plan."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        return source(spark, sf).select(name)

    QUERIES[name], SQL[name] = run, sql


for _name, _expr, _where in (
    ("month_total_length", "sum(rev_len)::BIGINT", f"rev_timestamp < {_Q} AND rev_is_redirect = 0"),
    ("articles_till_month", "count(*)", f"rev_timestamp < {_Q} AND rev_is_redirect = 0"),
    ("month_new_articles", "count(*)", f"rev_timestamp >= {_P} AND rev_timestamp < {_Q} AND rev_is_redirect = 0"),
    ("redirects_till_month", "count(*)", f"rev_timestamp < {_Q} AND rev_is_redirect = 1"),
    ("month_new_redirects", "count(*)", f"rev_timestamp >= {_P} AND rev_timestamp < {_Q} AND rev_is_redirect = 1"),
):
    _one(_name, _article_counts, f"WITH {_REV}, {_ARTICLES}, {_FIRST} SELECT {_expr} AS {_name} FROM fa WHERE {_where}")

_SPANS = f"""
spans AS (SELECT rev_page, min(rev_timestamp) FILTER (WHERE rev_fa = 1) AS min_ts_fa, max(rev_timestamp) FILTER (WHERE rev_fa = 1) AS max_ts_fa,
                 max(rev_timestamp) FILTER (WHERE rev_fa = 0) AS max_ts_nofa FROM rev WHERE rev_timestamp < {_Q} GROUP BY rev_page HAVING max(rev_fa) = 1)
"""


def _spans(spark: SparkSession, sf: str) -> DataFrame:
    return pages.featured_spans(revision(spark, sf, BEFORE_END), UP)


@query(f"WITH {_REV}, {_SPANS} SELECT rev_page, min_ts_fa, max_ts_fa FROM spans")
def fa_ts(spark: SparkSession, sf: str) -> DataFrame:
    return _spans(spark, sf).select("rev_page", "min_ts_fa", "max_ts_fa")


@query(f"WITH {_REV}, {_SPANS} SELECT rev_page, max_ts_nofa FROM spans WHERE max_ts_nofa IS NOT NULL")
def nofa_maxts(spark: SparkSession, sf: str) -> DataFrame:
    return _spans(spark, sf).select("rev_page", "max_ts_nofa").where("max_ts_nofa is not null")


_one("month_fa", lambda s, d: pages.featured_counts(_spans(s, d), LOW), f"WITH {_REV}, {_SPANS} SELECT count(*) AS month_fa FROM spans WHERE max_ts_nofa < max_ts_fa")
_one("month_new_fa", lambda s, d: pages.featured_counts(_spans(s, d), LOW), f"WITH {_REV}, {_SPANS} SELECT count(*) AS month_new_fa FROM spans WHERE min_ts_fa >= {_P}")


# --- editors --------------------------------------------------------------------------------------


@query(f"WITH {_REV}, {_BOTS}, {_MONTH} SELECT * FROM month")
def rev_month(spark: SparkSession, sf: str) -> DataFrame:
    return editors.month_revisions(revision(spark, sf, f"{IN_PERIOD} and rev_user > 0"), LOW, UP)


@query(f"WITH {_REV}, {_BOTS}, {_MONTH} SELECT * FROM human")
def rev_month_nobots(spark: SparkSession, sf: str) -> DataFrame:
    return editors.without_bots(rev_month(spark, sf), table(spark, sf, "user_groups"))


def _editor_counts(active: int = editors.ACTIVE, very: int = editors.VERY_ACTIVE) -> Callable[[SparkSession, str], DataFrame]:
    return lambda s, d: editors.editor_counts(rev_month_nobots(s, d), active, very)


_WITH = f"WITH {_REV}, {_BOTS}, {_MONTH}"
_one("month_users", _editor_counts(), f"{_WITH} SELECT count(DISTINCT rev_user) AS month_users FROM human")
for _name, _n in (("month_active_users", editors.ACTIVE), ("month_very_active_users", editors.VERY_ACTIVE)):
    _one(_name, _editor_counts(), f"{_WITH} SELECT count(*) AS {_name} FROM (SELECT rev_user FROM human GROUP BY rev_user HAVING count(*) > {_n})")


@query(f"""WITH {_REV} SELECT rev_user, count(*) AS n FROM rev WHERE rev_user > 0 GROUP BY rev_user HAVING count(*) > 30""")
def users_above_30_edits(spark: SparkSession, sf: str) -> DataFrame:
    return revision(spark, sf, "rev_user > 0").groupBy("rev_user").agg(F.count("*").alias("n")).where("n > 30")


_one(
    "month_sysops",
    lambda s, d: editors.sysop_count(rev_month_nobots(s, d), table(s, d, "user_groups")),
    f"{_WITH} SELECT count(DISTINCT rev_user) AS month_sysops FROM human WHERE rev_user IN (SELECT ug_user FROM user_groups WHERE ug_group = 'sysop')",
)
for _name, _from in (("month_edits", f"rev WHERE rev_timestamp >= {_P} AND rev_timestamp < {_Q}"), ("month_edits_reg", "month"), ("month_edits_nobots", "human")):
    _one(_name, lambda s, d: editors.edit_counts(revision(s, d, IN_PERIOD), table(s, d, "user_groups"), LOW, UP), f"{_WITH} SELECT count(*) AS {_name} FROM {_from}")


@query(f"""{_WITH} SELECT (SELECT count(DISTINCT rev_user) FROM month)
 - (SELECT count(*) FROM (SELECT rev_user FROM human GROUP BY rev_user HAVING count(*) > 5)) AS other_contributors""")
def other_contributors(spark: SparkSession, sf: str) -> DataFrame:
    every = rev_month(spark, sf).agg(F.count_distinct("rev_user").alias("_all"))
    active = editors.editor_counts(rev_month_nobots(spark, sf)).select("month_active_users")
    return every.crossJoin(F.broadcast(active)).select((F.col("_all") - F.col("month_active_users")).alias("other_contributors"))


@query(f"""WITH {_REV}, {_BOTS}, ops AS (SELECT DISTINCT ug_user FROM user_groups WHERE ug_group = 'sysop'),
pu AS (SELECT strftime(rev_timestamp, '%Y-%m') AS month, rev_user, count(*) AS n FROM rev WHERE rev_timestamp IS NOT NULL AND rev_user IS NOT NULL GROUP BY 1, 2),
mk AS (SELECT *, rev_user > 0 AS reg, rev_user > 0 AND rev_user NOT IN (SELECT ug_user FROM bots) AS hum, rev_user IN (SELECT ug_user FROM ops) AS op FROM pu)
SELECT month, sum(n)::BIGINT AS month_edits, coalesce(sum(n) FILTER (WHERE reg), 0)::BIGINT AS month_edits_reg, coalesce(sum(n) FILTER (WHERE hum), 0)::BIGINT AS month_edits_nobots,
  count(*) FILTER (WHERE hum) AS month_users, count(*) FILTER (WHERE hum AND n > 5) AS month_active_users, count(*) FILTER (WHERE hum AND n > 100) AS month_very_active_users,
  count(*) FILTER (WHERE hum AND op) AS month_sysops, count(*) FILTER (WHERE reg) - count(*) FILTER (WHERE hum AND n > 5) AS other_contributors
FROM mk GROUP BY month""")
def monthly_activity_summary(spark: SparkSession, sf: str) -> DataFrame:
    return editors.monthly_activity(revision(spark, sf).where("rev_user is not null"), table(spark, sf, "user_groups"))


_WEEKS = f"""
weeks AS (SELECT date_trunc('week', rev_timestamp)::DATE AS week, count(*) AS new_editors FROM
  (SELECT *, row_number() OVER (PARTITION BY rev_user ORDER BY rev_timestamp, rev_id) AS rn FROM rev WHERE rev_user IS NOT NULL)
  WHERE rn = 1 AND rev_user NOT IN (SELECT ug_user FROM bots) AND year(rev_timestamp) >= 2009 AND rev_timestamp < '2019-01-01' GROUP BY 1)
"""


def _weeks(spark: SparkSession, sf: str) -> DataFrame:
    return editors.weekly_newcomers(revision(spark, sf), table(spark, sf, "user_groups"), 2009, datetime(2019, 1, 1))


@query(f"""WITH {_REV}, {_BOTS}, {_WEEKS} SELECT week, (year(week) * 100 + (dayofyear(week) - 1) // 7 + 1)::BIGINT AS year_week, new_editors FROM weeks""")
def new_editors_weekly(spark: SparkSession, sf: str) -> DataFrame:
    return _weeks(spark, sf).orderBy("week")


@query(f"""WITH {_REV}, {_BOTS}, {_WEEKS} SELECT week, new_editors, round(CASE WHEN count(*) OVER w = 12 THEN avg(new_editors) OVER w END, 6) AS moving_mean
FROM weeks WINDOW w AS (ORDER BY week ROWS BETWEEN 5 PRECEDING AND 6 FOLLOWING)""")
def new_editors_ma12(spark: SparkSession, sf: str) -> DataFrame:
    return stats.moving_mean(_weeks(spark, sf), [], "week", "new_editors").select("week", "new_editors", F.round("moving_mean", 6).alias("moving_mean"))


@query(f"""WITH {_REV}, s AS (SELECT date_trunc('month', rev_timestamp)::DATE AS month, CASE WHEN rev_user > 0 THEN 'registered' WHEN rev_user = 0 THEN 'anonymous' ELSE 'other' END AS kind,
  count(*) AS n FROM rev WHERE rev_timestamp IS NOT NULL AND rev_user IS NOT NULL GROUP BY 1, 2)
SELECT month, max(n) FILTER (WHERE kind = 'registered') AS registered, max(n) FILTER (WHERE kind = 'anonymous') AS anonymous, max(n) FILTER (WHERE kind = 'other') AS other FROM s GROUP BY month""")
def series_merge(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("rev_user") > 0, "registered").when(F.col("rev_user") == 0, "anonymous").otherwise("other")
    r = revision(spark, sf).where("rev_timestamp is not null and rev_user is not null")
    s = r.groupBy(stats.month_start("rev_timestamp").alias("month"), kind.alias("kind")).agg(F.count("*").alias("n"))
    return stats.merge_series(s, "month", "kind", "n", ["registered", "anonymous", "other"])


def _log_months(spark: SparkSession, sf: str) -> DataFrame:
    log = _log(spark, sf).select("timestamp", L.plain_label(F.col("type")).alias("log_type")).where(F.col("log_type").isin("block", "protect") & F.col("timestamp").isNotNull())
    n = log.groupBy("log_type", stats.month_start("timestamp").alias("month")).agg(F.count("*").alias("n"))
    return stats.fill_months(n, ["log_type"], "month", "n")


@query(f"""WITH {_LOG}, m AS (SELECT t AS log_type, date_trunc('month', ts)::DATE AS month, count(*) AS n FROM lg WHERE t IN ('block', 'protect') AND ts IS NOT NULL GROUP BY 1, 2),
g AS (SELECT log_type, unnest(generate_series(min(month)::TIMESTAMP, max(month)::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS month FROM m GROUP BY log_type)
SELECT log_type, month, year(month)::INT AS year, month(month)::INT AS month_no, coalesce(n, 0) AS n FROM g LEFT JOIN m USING (log_type, month)""")
def log_actions_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return _log_months(spark, sf).select("log_type", "month", F.year("month").alias("year"), F.month("month").alias("month_no"), "n").orderBy("log_type", "month")


@query()
def stl_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return stats.stl(_log_months(spark, sf), ["log_type"], "month", "n")


@query(f"WITH {_REV} SELECT rev_user, count(*) AS n FROM rev WHERE rev_user > 0 GROUP BY rev_user")
def edits_per_user(spark: SparkSession, sf: str) -> DataFrame:
    return revision(spark, sf, "rev_user > 0").groupBy("rev_user").agg(F.count("*").alias("n"))


_EDITS = "e AS (SELECT rev_user, count(*) AS n FROM rev WHERE rev_user > 0 GROUP BY rev_user)"


@query(f"""WITH {_REV}, {_EDITS}, r AS (SELECT n AS x, row_number() OVER (ORDER BY n, rev_user) AS i, count(*) OVER () AS m FROM e)
SELECT max(m) AS n, round(sum((2 * i - m - 1) * x) / (max(m) * sum(x)), 9) AS gini FROM r""")
def gini(spark: SparkSession, sf: str) -> DataFrame:
    return stats.gini(edits_per_user(spark, sf), "n").select("n", F.round("gini", 9).alias("gini"))


@query(f"""WITH {_REV}, {_EDITS}, v AS (SELECT n AS x, count(*) AS m FROM e GROUP BY n)
SELECT 0.0 AS p, 0.0 AS l UNION ALL
SELECT round(sum(m) OVER (ORDER BY x) / (SELECT sum(m) FROM v), 9)::DOUBLE, round(sum(x * m) OVER (ORDER BY x) / (SELECT sum(x * m) FROM v), 9)::DOUBLE FROM v""")
def lorenz(spark: SparkSession, sf: str) -> DataFrame:
    return stats.lorenz(edits_per_user(spark, sf), "n").select(F.round("p", 9).alias("p"), F.round("l", 9).alias("l"))


def _user_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return revision(spark, sf, "rev_user > 0").groupBy("rev_user").agg(F.count("*").alias("n"), F.count_distinct("rev_page").alias("n_pages"), F.sum("rev_len").alias("len"))


_SIZES = "z AS (SELECT rev_user, count(*) AS n, count(DISTINCT rev_page) AS n_pages, sum(rev_len) AS len FROM rev WHERE rev_user > 0 GROUP BY rev_user)"


@query(f"""WITH {_REV}, {_SIZES} SELECT count(*) AS n, round(regr_slope(ln(n_pages), ln(n)), 8) AS slope, round(regr_intercept(ln(n_pages), ln(n)), 8) AS intercept,
round(regr_r2(ln(n_pages), ln(n)), 8) AS r2 FROM z WHERE n_pages > 0""")
def loglog_ols(spark: SparkSession, sf: str) -> DataFrame:
    fit = stats.ols(_user_sizes(spark, sf).where("n_pages > 0"), F.ln("n_pages"), F.ln("n"))
    return fit.select("n", *[F.round(c, 8).alias(c) for c in ("slope", "intercept", "r2")])


@query(f"""WITH {_REV}, {_SIZES}, f AS (SELECT regr_slope(ln(n_pages), ln(n)) AS s, regr_intercept(ln(n_pages), ln(n)) AS i FROM z WHERE n_pages > 0)
SELECT rev_user, round(ln(n_pages) - i - s * ln(n), 6) AS residual FROM z, f WHERE n_pages > 0 ORDER BY abs(ln(n_pages) - i - s * ln(n)) DESC, rev_user LIMIT 4""")
def regression_extremes(spark: SparkSession, sf: str) -> DataFrame:
    top = stats.residual_extremes(_user_sizes(spark, sf).where("n_pages > 0"), "rev_user", F.ln("n_pages"), F.ln("n"))
    return top.select("rev_user", F.round("residual", 6).alias("residual"))


@query(f"""WITH {_REV}, {_SIZES} SELECT 'n' AS column_name, count(n) AS n, count(*) - count(n) AS missing, count(DISTINCT n) AS n_distinct, round(avg(n), 6) AS mean, min(n)::DOUBLE AS lowest,
  quantile_cont(n, 0.05) AS p05, quantile_cont(n, 0.25) AS p25, quantile_cont(n, 0.5) AS p50, quantile_cont(n, 0.75) AS p75, quantile_cont(n, 0.95) AS p95, max(n)::DOUBLE AS highest FROM z
UNION ALL SELECT 'len', count(len), count(*) - count(len), count(DISTINCT len), round(avg(len), 6), min(len)::DOUBLE, quantile_cont(len::DOUBLE, 0.05), quantile_cont(len::DOUBLE, 0.25),
  quantile_cont(len::DOUBLE, 0.5), quantile_cont(len::DOUBLE, 0.75), quantile_cont(len::DOUBLE, 0.95), max(len)::DOUBLE FROM z""")
def describe_stats(spark: SparkSession, sf: str) -> DataFrame:
    return stats.describe(_user_sizes(spark, sf), ["n", "len"]).withColumn("mean", F.round("mean", 6))


@query(f"""WITH {_REV}, {_SIZES}, q AS (SELECT quantile_cont(n, 0.25) AS a, quantile_cont(n, 0.75) AS b FROM z)
SELECT rev_user, n FROM z, q WHERE n < a - 1.5 * (b - a) OR n > b + 1.5 * (b - a)""")
def boxplot_outliers(spark: SparkSession, sf: str) -> DataFrame:
    return stats.box_outliers(_user_sizes(spark, sf), "rev_user", "n")


@query(f"""WITH {_REV}, {_SIZES}, g AS (SELECT CASE WHEN n > 0 THEN ln(n) END AS n, CASE WHEN n_pages > 0 THEN ln(n_pages) END AS p, CASE WHEN len > 0 THEN ln(len) END AS l FROM z)
SELECT 'n' AS x, 'n_pages' AS y, round(corr(n, p), 8) AS r FROM g UNION ALL SELECT 'n', 'len', round(corr(n, l), 8) FROM g UNION ALL SELECT 'n_pages', 'len', round(corr(p, l), 8) FROM g""")
def log_correlations(spark: SparkSession, sf: str) -> DataFrame:
    return stats.correlations(_user_sizes(spark, sf), ["n", "n_pages", "len"]).withColumn("r", F.round("r", 8))


@query()
def lowess_weekly(spark: SparkSession, sf: str) -> DataFrame:
    w = _weeks(spark, sf).select(F.datediff("week", F.lit("2009-01-01")).alias("day"), "new_editors")
    return stats.lowess(w.withColumn("series", F.lit("new_editors")), ["series"], "day", "new_editors")


@query(f"WITH {_REV} SELECT DISTINCT rev_page FROM rev WHERE rev_page IS NOT NULL ORDER BY md5(rev_page::VARCHAR), rev_page LIMIT 50")
def sample_pages(spark: SparkSession, sf: str) -> DataFrame:
    return stats.sample_keys(table(spark, sf, "revision"), "rev_page", 50)


@query(f"""WITH {_REV}, k AS (SELECT DISTINCT rev_page FROM rev WHERE rev_page IS NOT NULL ORDER BY md5(rev_page::VARCHAR), rev_page LIMIT 50)
SELECT ' dewiki ' AS lang, rev_id, rev_page, rev_user, rev_timestamp::DATE AS rev_date, rev_minor_edit FROM rev WHERE rev_page IN (SELECT rev_page FROM k)""")
def sampled_revisions(spark: SparkSession, sf: str) -> DataFrame:
    """The revisions of the sampled pages by one semi join, with a constant language column."""
    r = revision(spark, sf)
    return r.join(sample_pages(spark, sf), "rev_page", "left_semi").select(
        F.lit(" dewiki ").alias("lang"), "rev_id", "rev_page", "rev_user", F.to_date("rev_timestamp").alias("rev_date"), "rev_minor_edit"
    )


@query("""WITH z AS (SELECT log_id, log_id * log_id * 37 AS size FROM (SELECT DISTINCT log_id FROM logging))
SELECT log_id, CASE WHEN size < 1048576 THEN printf('%.1f KiB', size / 1024.0) WHEN size < 1073741824 THEN printf('%.1f MiB', size / 1048576.0)
WHEN size < 1099511627776 THEN printf('%.1f GiB', size / 1073741824.0) ELSE printf('%.1f TiB', size / 1099511627776.0) END AS human FROM z""")
def file_size_human(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "logging").select("log_id").distinct()
    return d.select("log_id", human_size(F.col("log_id") * F.col("log_id") * 37).alias("human"))


# --- joins ----------------------------------------------------------------------------------------

_RANGES = [(k * 40_000_000, k * 40_000_000 + (30_000_000 if k % 3 else 39_999_999), f"C{k:02d}") for k in range(0, 107, 2)]
_RANGE_SQL = "ranges(lo, hi, country) AS (VALUES " + ", ".join(f"({a}::BIGINT, {b}::BIGINT, '{c}')" for a, b, c in _RANGES) + ")"


def _addresses(spark: SparkSession, sf: str) -> DataFrame:
    r = revision(spark, sf, "rev_user = 0").select("rev_id", "rev_page")
    return r.withColumn("ip_v4", F.pmod(F.col("rev_id") * 2_654_435_761, F.lit(4_294_967_296)))


_ADDR = "addr AS (SELECT rev_id, rev_page, (rev_id * 2654435761) % 4294967296 AS ip_v4 FROM rev WHERE rev_user = 0)"


def _located(spark: SparkSession, sf: str) -> DataFrame:
    return countries.attach_country(_addresses(spark, sf), "ip_v4", spark.createDataFrame(_RANGES, "lo long, hi long, country string"))


@query(f"WITH {_REV}, {_RANGE_SQL}, {_ADDR} SELECT rev_id, rev_page, ip_v4, country FROM addr LEFT JOIN ranges ON ip_v4 BETWEEN lo AND hi")
def ip_country(spark: SparkSession, sf: str) -> DataFrame:
    return _located(spark, sf)


@query(f"""WITH {_REV}, {_RANGE_SQL}, {_ADDR}, c AS (SELECT rev_page, coalesce(country, 'Unknown') AS country, count(*) AS n_edits FROM addr LEFT JOIN ranges ON ip_v4 BETWEEN lo AND hi GROUP BY 1, 2)
SELECT rev_page, country, n_edits, round(n_edits / sum(n_edits) OVER (PARTITION BY rev_page), 9)::DOUBLE AS share FROM c""")
def country_contrib(spark: SparkSession, sf: str) -> DataFrame:
    return countries.country_shares(_located(spark, sf), "rev_page").withColumn("share", F.round("share", 9))


@query(f"""WITH {_REV}, p AS (SELECT page_id, arg_max(page_namespace, loaded_at) AS ns FROM page GROUP BY page_id)
SELECT coalesce(n.name, '?') AS namespace, count(*) AS n FROM rev JOIN p ON rev_page = page_id LEFT JOIN wiki_namespace n ON n.code = p.ns GROUP BY 1""")
def page_ns_join(spark: SparkSession, sf: str) -> DataFrame:
    """Edits per namespace. Counts per page come first, so the join carries one row per page whatever the skew."""
    per_page = revision(spark, sf).where("rev_page is not null").groupBy("rev_page").agg(F.count("*").alias("_n"))
    p = table(spark, sf, "page").groupBy("page_id").agg(F.max_by("page_namespace", "loaded_at").alias("ns"))
    names = table(spark, sf, "wiki_namespace")
    j = per_page.join(p, per_page["rev_page"] == p["page_id"]).groupBy("ns").agg(F.sum("_n").alias("_n")).join(names, F.col("ns") == names["code"], "left")
    return j.groupBy(F.coalesce("name", F.lit("?")).alias("namespace")).agg(F.sum("_n").alias("n"))


@query(f"""WITH {_REV}, g AS (SELECT ug_user, string_agg(DISTINCT ug_group, ',' ORDER BY ug_group) AS g FROM user_groups GROUP BY ug_user)
SELECT u.rev_user, coalesce(g, 'registered') AS user_group FROM (SELECT DISTINCT rev_user FROM rev WHERE rev_user > 0) u LEFT JOIN g ON u.rev_user = ug_user""")
def user_group_label(spark: SparkSession, sf: str) -> DataFrame:
    return editors.group_label(revision(spark, sf, "rev_user > 0").select("rev_user").distinct(), table(spark, sf, "user_groups"))


@query(f"""WITH {_REV}, o AS (SELECT rev_user, rev_timestamp, min(rev_id) AS rev_id FROM rev WHERE rev_user IS NOT NULL AND rev_timestamp IS NOT NULL GROUP BY 1, 2)
SELECT rev_user, rev_id, (epoch_us(lead(rev_timestamp) OVER (PARTITION BY rev_user ORDER BY rev_timestamp)) - epoch_us(rev_timestamp)) // 1000000 AS gap_s FROM o""")
def inter_edit_time(spark: SparkSession, sf: str) -> DataFrame:
    return editors.inter_edit_seconds(revision(spark, sf), "rev_user")


@query(f"""WITH {_REV}, w AS (SELECT user_id, max(user_name) AS user_name FROM wiki_user GROUP BY user_id)
SELECT rev_id, rev_user, user_name FROM rev LEFT JOIN w ON rev_user = user_id""")
def revision_user_names(spark: SparkSession, sf: str) -> DataFrame:
    """A skewed equi-join: the heavy users' names are broadcast, the rest is shuffled."""
    w = table(spark, sf, "wiki_user").where("user_id is not null").groupBy("user_id").agg(F.max("user_name").alias("user_name"))
    return heavy_join(revision(spark, sf).select("rev_id", "rev_user"), w, "rev_user", "user_id", ["user_name"]).select("rev_id", "rev_user", "user_name")


@query("""SELECT event_id, (year(w) * 100 + (dayofyear(w) - 1) // 7 + 1)::BIGINT AS yw FROM (SELECT event_id, date_trunc('week', ts)::DATE AS w FROM events)""")
def event_year_week(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", year_week(F.col("ts")).alias("yw"))
