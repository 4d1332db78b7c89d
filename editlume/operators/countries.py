"""Addresses to countries by interval join, and contribution shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PREFIX_BITS = 16
UNKNOWN = "Unknown"


def attach_country(addresses: DataFrame, ip: str, ranges: DataFrame) -> DataFrame:
    """Adds `country` of the range (lo, hi, country; both ends inside) that holds the number in `ip`; NULL if none does.

    Ranges are cut at /16 borders and joined on the prefix, so the interval join is an equi-join
    with a residual: it shuffles like any other and needs no broadcast. A range is at most 65,536
    pieces, one for each prefix it touches. Ranges do not overlap; where they do, the smallest country
    code wins. NULL addresses and ranges with a NULL end match nothing.
    """
    size = 1 << PREFIX_BITS
    cut = ranges.where("lo <= hi").select("lo", "hi", F.col("country").alias("_country"), F.explode(F.sequence(F.floor(F.col("lo") / size), F.floor(F.col("hi") / size))).alias("_prefix"))
    keys = addresses.select(F.col(ip).alias("_ip")).where("_ip is not null").distinct().withColumn("_prefix", F.floor(F.col("_ip") / size))
    hit = keys.join(cut, "_prefix").where("_ip between lo and hi").groupBy("_ip").agg(F.min("_country").alias("country"))
    return addresses.join(hit, addresses[ip] == hit["_ip"], "left").drop("_ip")


def country_shares(edits: DataFrame, page: str, country: str = "country") -> DataFrame:
    """Per page and country: edits and their share of the page's."""
    n = edits.groupBy(page, F.coalesce(F.col(country), F.lit(UNKNOWN)).alias("country")).agg(F.count("*").alias("n_edits"))
    return n.withColumn("share", F.col("n_edits") / F.sum("n_edits").over(Window.partitionBy(page)))
