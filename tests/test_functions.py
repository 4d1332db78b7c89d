"""Enrichment expressions: the expected values of single cases."""

from __future__ import annotations

import hashlib
from datetime import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from editlume.functions import logitem as L
from editlume.functions import revision as R
from editlume.functions.ip import ipv4_to_long, strip_octet_zeros
from editlume.functions.patterns import FEATURED_ARTICLE, FEATURED_LIST, GOOD_ARTICLE
from editlume.functions.text import hrefs, human_size, year_week
from editlume.operators.logsplit import split_log


def col(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def one(spark, values, expr, kind="string"):
    return [r[0] for r in col(spark, values, kind).select(expr(F.col("x"))).collect()]


def test_length_and_digest(spark):
    texts = ["é", "", None, "𐌰\"x"]
    assert one(spark, texts, R.byte_length) == [2, 0, 0, 6]
    assert one(spark, texts, R.text_digest) == [hashlib.sha256((t or "").encode()).hexdigest() for t in texts]


def test_redirect(spark):
    assert one(spark, ["#redirect [[x]]", "#REDIRECT", " #REDIRECT", "#REDIREC", None], R.is_redirect) == [1, 1, 0, 0, 0]


def test_all_patterns_compile_and_agree(spark):
    con = duckdb.connect()
    samples = ["{{Featured article}}", "{{vetrina|x}}", "{{Bon article|oldid=3}}", "{{1000+AdQ|2}}", "{{Gæðagrein}}", "{{medal}}", "a\rb", "{{Kiemelt\rx}}"]
    patterns = [p for m in (FEATURED_ARTICLE, FEATURED_LIST, GOOD_ARTICLE) for p in m.values() if p]
    assert len(patterns) == 55 and len(FEATURED_ARTICLE) == 44
    df = col(spark, samples)
    rows = df.select("x", *[F.col("x").rlike("(?d)" + p).alias(f"p{i}") for i, p in enumerate(patterns)]).collect()
    for r in rows:
        for i, p in enumerate(patterns):
            assert r[f"p{i}"] == con.execute("SELECT regexp_matches(?, ?)", [r["x"], p]).fetchall()[0][0], (r["x"], p)


def test_unsupported_wiki():
    with pytest.raises(RuntimeError):
        R.status_flags(F.lit(""), F.lit(0), "xxwiki")


def test_flag_only_in_main_namespace(spark):
    df = spark.createDataFrame([("{{Featured article}}", 0), ("{{Featured article}}", 1), (None, 0)], "t string, ns int")
    assert [r[0] for r in df.select(R.status_flags(F.col("t"), F.col("ns"), "enwiki")["rev_fa"]).collect()] == [1, 0, 0]


def test_editor_classes(spark):
    rows = [("1.2.3.4", None, None), (None, 5, "A"), (None, 0, "B"), (None, None, None), (None, None, "C"), ("::1", 7, "D")]
    df = spark.createDataFrame(rows, "ip string, id long, n string")
    assert [r[0] for r in df.select(R.editor_id(F.col("ip"), F.col("id"), F.col("n"))).collect()] == [0, 5, -2, -1, -2, 0]


def test_ip(spark):
    assert one(spark, ["24.251.243.233", "::1", "1.2.3", "256.1.1.1", None, "01.2.3.4"], ipv4_to_long) == [419165161, None, None, None, None, None]
    assert one(spark, ["010.001.000.020", "10.0.0.1", "05.1.1.1", "100.000.012.3"], strip_octet_zeros) == ["10.1.0.20", "10.0.0.1", "05.1.1.1", "100.0.12.3"]


def test_minor_and_time(spark):
    assert one(spark, ["", None], R.minor_edit) == [1, 0]
    assert one(spark, ["", None], lambda c: R.minor_edit(c, compat=True)) == [0, 1]
    assert one(spark, ["2005-01-25T06:55:26Z", "x", None], R.iso_timestamp) == [datetime(2005, 1, 25, 6, 55, 26), None, None]


def test_namespace(spark):
    ns = {"MediaWiki": 8, "User talk": 3, "": 0}
    assert one(spark, ["MediaWiki:1911", "User talk:A:B", "Plain", "Foo:x", "", None], lambda c: L.title_namespace(c, ns)) == [8, 0, 0, 0, -1000, -1000]


def test_log_split(spark):
    when = datetime(2014, 1, 21, 10, 14, 10)
    serial = 'a:2:{s:12:"4::oldgroups";a:0:{}s:12:"5::newgroups";a:1:{i:0;s:5:"sysop";}}'
    rows = [
        (1, when, 5, "U", "c", "review", "approve", "X", "123"), (2, when, 5, "U", "c", "review", "approve", "X", "123\n100\n20100101"),
        (3, when, None, None, None, "block", "block", "User:Bob", "1 week"), (4, when, 5, "U", "c", "block", "block", "User:010.001.000.020", "24 hours"),
        (5, when, 5, "U", "c", "block", "block", "User:999.1.1.1", "indefinite"), (6, when, 5, "U", "c", "block", "reblock", "User:B", "Wed, 22 Jan 2014 10:14:10 GMT"),
        (7, when, 5, "U", "c", "block", "block", "User:B", None), (8, when, 5, "U", "c", "newusers", "create2", "User:N", None),
        (9, when, 5, "U", "c", "rights", "rights", "User:R", "a\nb"), (10, when, 5, "U", "c", "rights", "rights", "User:R", serial),
        (11, when, 5, "U", "cc", "rights", "rights", "User:R", None), (12, when, 5, "U", None, "rights", "rights", "NoColon", "one"),
        (13, when, 5, "U", "c", "block", "block", "User:B", "1 year"), (14, when, 5, "U", "c", "block", "block", "User:B", "3 months"),
        (15, when, 5, "U", "c", "block", "block", "User:B", "Thu, 23 Jan 2014 10:14:10 GMT"), (16, when, 5, "U", "c", "review", "approve", "X", "x\ny"),
    ]
    df = spark.createDataFrame(rows, "id long, timestamp timestamp_ntz, user_id long, username string, comment string, type string, action string, title string, params string")
    out = split_log(df, {"User": 2})
    log = {r.log_id: r for r in out["logging"].collect()}
    assert len(log) == 16 and (log[1].log_new_flag, log[1].log_old_flag) == (123, 0) and (log[2].log_new_flag, log[2].log_old_flag) == (123, 100)
    assert log[3].log_user == -1 and log[3].log_namespace == 2 and log[3].log_comment == "" and log[16].log_new_flag == 0
    block = {r.block_id: r for r in out["block"].collect()}
    assert (block[3].block_target, block[3].block_ip, float(block[3].block_duration)) == ("Bob", None, 604800.0)
    assert block[4].block_ip == 167837716 and float(block[4].block_duration) == 86400.0
    assert block[5].block_ip == 0 and float(block[5].block_duration) == 86400000000000.0
    assert [float(block[k].block_duration) for k in (6, 7, 13, 14, 15)] == [86400.0, 0.0, 31557600.0, 7776000.0, 172800.0]
    assert [r.user_log_id for r in out["user_new"].collect()] == [8]
    level = {r.level_log_id: (r.level_username, r.level_old, r.level_new) for r in out["user_level"].collect()}
    assert level == {9: ("R", "a", "b"), 10: ("R", "[]", "['sysop']"), 11: ("R", "", "cc"), 12: ("", "", "one")}


def test_text_helpers(spark):
    assert one(spark, [0, 500, 1024, 231_300, 10**15, -1, None], human_size, "long") == ["0.0 KiB", "0.5 KiB", "1.0 KiB", "225.9 KiB", "909.5 TiB", None, None]
    assert one(spark, [1500], lambda c: human_size(c, 1000), "long") == ["1.5 KB"]
    assert one(spark, ['<a href="x.gz">', None], hrefs) == [["x.gz"], None]
    weeks = [datetime(2012, 1, 1), datetime(2012, 1, 2), datetime(2012, 12, 31)]
    assert one(spark, weeks, year_week, "timestamp_ntz") == [201152, 201201, 201253]


def test_expiry_dates(spark):
    """The same moment in many notations; what is no date has none."""
    same = [
        "Wed, 22 Jan 2014 10:14:10 GMT", "2014-01-22T10:14:10Z", "2014-01-22 10:14:10", "2014-01-22T12:14:10+02:00", "22 January 2014 05:14:10 -0500", "10:14:10, 22 January 2014",
        "January 22, 2014 10:14:10", "20140122101410", "2014-01-22T10:14:10.250Z", "Wednesday, 22 Jan 2014 10:14:10 UTC", "Tue, 21 Jan 2014 23:14:10 -1100",
    ]
    other = {"2014-01-22 10:14": 86390, "22 Jan 2014": 49550, "2014-01-22": 49550, "10:14, 22 January 2014": 86390, "next week some day": 0, "": 0, "2014-13-45": 0}
    rows = [(t, 86400) for t in same] + list(other.items())
    df = spark.createDataFrame(rows, "t string, want long").withColumn("at", F.lit("2014-01-21 10:14:10").cast("timestamp_ntz"))
    got = df.select("t", "want", L.block_duration(F.col("t"), F.col("at")).alias("d")).collect()
    assert [(r.t, float(r.d)) for r in got] == [(r.t, float(r.want)) for r in got]
