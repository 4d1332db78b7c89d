"""Pages, articles and featured articles over time."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def moment(t: datetime) -> Column:
    """A literal without a zone, as the time columns are: a plain one would be read in the host's zone."""
    return F.lit(t.isoformat(" ")).cast("timestamp_ntz")


def until(ts: str, up: datetime) -> Column:
    return F.col(ts) <= moment(up)


def within(ts: str, low: datetime, up: datetime) -> Column:
    """The half-open period [low, up)."""
    return (F.col(ts) >= moment(low)) & (F.col(ts) < moment(up))


def articles(page: DataFrame) -> DataFrame:
    """Main-namespace pages, one row per id (the latest load holds)."""
    once = page.groupBy("page_id").agg(F.max_by(F.struct("page_namespace", "page_title"), "loaded_at").alias("_p"))
    return once.where("_p.page_namespace = 0").select("page_id", F.col("_p.page_title").alias("page_title"))


def first_revisions(revision: DataFrame, key: str) -> DataFrame:
    """The first revision, by (timestamp, id), of each page or user: a partial aggregate, no ordering of the history."""
    row = F.struct("rev_id", "rev_page", "rev_user", "rev_timestamp", "rev_len", "rev_is_redirect")
    first = revision.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.min_by(row, F.struct("rev_timestamp", "rev_id")).alias("_r"))
    return first.select("_r.*")


def first_article_revisions(revision: DataFrame, page: DataFrame) -> DataFrame:
    a = articles(page)
    return first_revisions(revision, "rev_page").join(a, F.col("rev_page") == a["page_id"])


def article_counts(first: DataFrame, low: datetime, up: datetime) -> DataFrame:
    """One row: total length, articles and redirects until `up`, new ones within [low, up), in one pass."""
    till, new = F.col("rev_timestamp") < moment(up), within("rev_timestamp", low, up)
    real, redirect = F.col("rev_is_redirect") == 0, F.col("rev_is_redirect") == 1
    return first.agg(
        F.sum(F.when(till & real, F.col("rev_len"))).alias("month_total_length"),
        F.count_if(till & real).alias("articles_till_month"),
        F.count_if(new & real).alias("month_new_articles"),
        F.count_if(till & redirect).alias("redirects_till_month"),
        F.count_if(new & redirect).alias("month_new_redirects"),
    )


def featured_spans(revision: DataFrame, up: datetime) -> DataFrame:
    """Per page ever featured before `up`: first and last featured time and last unfeatured time (NULL if none)."""
    fa, other = F.col("rev_fa") == 1, F.col("rev_fa") == 0
    spans = revision.where(F.col("rev_timestamp") < moment(up)).groupBy("rev_page").agg(
        F.min(F.when(fa, F.col("rev_timestamp"))).alias("min_ts_fa"),
        F.max(F.when(fa, F.col("rev_timestamp"))).alias("max_ts_fa"),
        F.max(F.when(other, F.col("rev_timestamp"))).alias("max_ts_nofa"),
    )  # one pass replaces the two tables and their join
    return spans.where("min_ts_fa is not null")


def featured_counts(spans: DataFrame, low: datetime, keep_always_featured: bool = False) -> DataFrame:
    """month_fa: pages whose latest state is featured; month_new_fa: first featured since `low`.

    Pages never seen unfeatured count only with `keep_always_featured`.
    """
    kept = F.col("max_ts_nofa") < F.col("max_ts_fa")
    if keep_always_featured:
        kept = kept | F.col("max_ts_nofa").isNull()
    return spans.agg(F.count_if(kept).alias("month_fa"), F.count_if(F.col("min_ts_fa") >= moment(low)).alias("month_new_fa"))
