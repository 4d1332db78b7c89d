"""Readers, sinks and whole jobs on small dumps written here."""

from __future__ import annotations

import bz2
import gzip
import hashlib
import lzma

import pytest

from editlume.config import JobConfig, from_args
from editlume.plans.jobs import page_logging, revision_history, sql_dumps
from editlume.sources.files import find_dumps, listing_links, read_ip_ranges, read_summary, verify_md5
from editlume.sources.sinks import append_result, create_tables, duplicate_keys, read_table, write_metrics_csv
from editlume.sources.sql_dump import insert_tuples, read_sql_dump
from editlume.sources.xml_dump import corrupt_records, history_tables, pages, read_namespaces, read_pages_raw, read_revisions_raw, revisions

XML = """<mediawiki>
  <siteinfo><namespaces><namespace key="0" case="first-letter" /><namespace key="1" case="first-letter">Talk</namespace></namespaces></siteinfo>
  <page><title>One</title><ns>0</ns><id>10</id>
    <revision><id>7</id><parentid>99</parentid><timestamp>2008-01-01T00:00:00Z</timestamp><contributor><ip>24.251.243.233</ip></contributor><comment>&lt;b&gt; "q" \U00010330</comment><text xml:space="preserve">héllo </text></revision>
    <revision><id>5</id><timestamp>2008-01-02T00:00:00Z</timestamp><contributor><username>Ann</username><id>3</id></contributor><minor /><text xml:space="preserve">{{Featured article}}</text></revision>
    <revision><id>9</id><timestamp>2008-01-03T00:00:00Z</timestamp><contributor deleted="deleted" /><text deleted="deleted" /></revision>
    <revision><id>11</id><timestamp>2008-01-03T00:00:00Z</timestamp><contributor><username>Old</username><id>0</id></contributor><text xml:space="preserve">#redirect [[X]]</text></revision>
  </page>
  <page><title>Talk:One</title><ns>1</ns><id>12</id><restrictions>sysop</restrictions>
    <revision><id>20</id><timestamp>2009-01-01T00:00:00Z</timestamp><contributor><ip>2001:db8::1</ip></contributor><text xml:space="preserve">{{Featured article}}</text></revision>
    <revision><id>21</id><timestamp>2009-01-01T00:00:00Z</timestamp><text xml:space="preserve"></text></revision>
  </page>
</mediawiki>"""
LOG = """<mediawiki><siteinfo><namespaces><namespace key="2" case="x">User</namespace></namespaces></siteinfo>
<logitem><id>1</id><timestamp>2014-01-21T10:14:10Z</timestamp><contributor><username>A</username><id>5</id></contributor><comment>c</comment><type>block</type><action>block</action><logtitle>User:Bob</logtitle><params xml:space="preserve">2 days</params></logitem>
<logitem><id>2</id><timestamp>2014-01-21T10:14:11Z</timestamp><type>rights</type><action>rights</action><logtitle>User:Bob</logtitle><params xml:space="preserve">a
b</params></logitem>
</mediawiki>"""
SQL = """CREATE TABLE `user_groups` (x int);
INSERT INTO `user_groups` VALUES (1,'bot'),(2,'it\\'s'),(3,'back\\\\slash'),(4,NULL),(5,'a,(b)');
-- INSERT INTO nothing
INSERT INTO `user_groups` VALUES (6,''),(7,_binary 'q''q'),(NULL,'x');
"""


def parsed(spark, path):
    return {r.rev_id: r for r in revisions(read_pages_raw(spark, str(path)), "enwiki").collect()}


def test_history_xml(spark, tmp_path):
    p = tmp_path / "x.xml"
    p.write_text(XML)
    rows = parsed(spark, p)
    assert [rows[k].rev_parent_id for k in (7, 5, 9, 11, 20, 21)] == [None, 7, 5, 9, None, 20]
    assert [rows[k].rev_user for k in (7, 5, 9, 11, 20, 21)] == [0, 3, -1, -2, 0, -1]
    assert [rows[k].rev_len for k in (7, 5, 9)] == [7, 20, 0]
    assert rows[7].rev_hash == hashlib.sha256("héllo ".encode()).hexdigest() and rows[9].rev_hash == hashlib.sha256(b"").hexdigest()
    assert (rows[5].rev_fa, rows[20].rev_fa, rows[11].rev_is_redirect, rows[5].rev_minor_edit, rows[7].rev_minor_edit) == (1, 0, 1, 1, 0)
    assert rows[7].rev_comment == '<b> "q" \U00010330'
    raw = read_pages_raw(spark, str(p))
    assert {r.page_id: r.page_restrictions for r in pages(raw).collect()} == {10: None, 12: "sysop"}
    assert {r.code: r.name for r in read_namespaces(spark, str(p)).collect()} == {0: "", 1: "Talk"}
    t = history_tables(revisions(raw, "enwiki"))
    assert {r.rev_id: r.ip_v4 for r in t["revision_ip"].collect()} == {7: 419165161, 20: None}
    assert {r.user_id: r.user_name for r in t["user"].collect()} == {3: "Ann", 0: "Anonymous user", -1: "NA", -2: "Missing ID"}
    assert [(r.rev_id, r.user_name) for r in t["revision_user_zero"].collect()] == [(11, "Old")]


@pytest.mark.parametrize("suffix, pack", [("gz", gzip.compress), ("bz2", bz2.compress), ("xz", lzma.compress), ("lzma", lambda b: lzma.compress(b, format=lzma.FORMAT_ALONE))])
def test_compressed_xml(spark, tmp_path, suffix, pack):
    (tmp_path / "a.xml").write_text(XML)
    q = tmp_path / f"b.xml.{suffix}"
    q.write_bytes(pack(XML.encode()))
    assert parsed(spark, q) == parsed(spark, tmp_path / "a.xml")


def test_broken_tail_and_7z(spark, tmp_path):
    p = tmp_path / "x.xml"
    p.write_text(XML.split("<page><title>Talk")[0] + "<page><title>cut</title><id>zz</id></page>")
    raw = read_pages_raw(spark, str(p))
    assert pages(raw).count() == 1 and corrupt_records(raw.cache()).count() == 1
    with pytest.raises(ValueError):
        read_pages_raw(spark, "x.7z")


def test_sql_dump(spark, tmp_path):
    p = tmp_path / "u.sql.gz"
    p.write_bytes(gzip.compress(SQL.encode()))
    got = sorted(((r.ug_user, r.ug_group) for r in read_sql_dump(spark, str(p), "user_groups").collect()), key=str)
    assert got == sorted([(1, "bot"), (2, "it's"), (3, "back\\slash"), (4, None), (5, "a,(b)"), (6, ""), (7, "q'q"), (None, "x")], key=str)
    assert list(insert_tuples("INSERT INTO t VALUES (1.5,'a b', -3),('x','y','z');")) == [["1.5", "a b", "-3"], ["x", "y", "z"]]


def test_jobs(spark, tmp_path):
    folder = tmp_path / "data" / "enwiki_dumps" / "20140101"
    folder.mkdir(parents=True)
    (folder / "enwiki-pages-meta-history1.xml").write_text(XML)
    (folder / "enwiki-pages-logging.xml").write_text(LOG)
    (folder / "enwiki-20140101-user_groups.sql").write_text(SQL)
    cfg = JobConfig("enwiki", "20140101", str(tmp_path / "data"), str(tmp_path / "out"))
    assert revision_history(spark, cfg) == {"page": 2, "namespaces": 2, "revision": 6, "revision_hash": 6, "revision_ip": 2, "user": 4, "revision_user_zero": 1}
    assert page_logging(spark, cfg) == {"logging": 2, "block": 1, "user_new": 0, "user_level": 1}
    assert sql_dumps(spark, cfg) == {"user_groups": 8}
    back = read_table(spark, cfg.output, "revision")
    assert back.count() == 6 and back.select("lang").distinct().first()[0] == "enwiki" and duplicate_keys(back, "rev_id").count() == 0
    with pytest.raises(FileNotFoundError):
        find_dumps(folder, "stub")


def test_files(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.bin").write_bytes(b"abc")
    (tmp_path / "m.txt").write_text(f"{hashlib.md5(b'abc').hexdigest()}  a.bin\n{'0' * 32}  gone.bin\n")
    assert {r.name: r.ok for r in verify_md5(spark, str(tmp_path / "d"), str(tmp_path / "m.txt")).collect()} == {"a.bin": True, "gone.bin": False}
    (tmp_path / "l.html").write_text('<b>Dump complete</b> <a href="x.7z">x</a>\n<a href="y.txt">')
    (tmp_path / "r.csv").write_text('"1.0.0.0","1.0.0.255","AU"\n"::1","::2","ZZ"\n')
    assert [r.href for r in listing_links(spark, str(tmp_path / "l.html"), r".*\.7z").collect()] == ["x.7z"]
    assert [(r.lo, r.hi, r.country) for r in read_ip_ranges(spark, str(tmp_path / "r.csv")).collect()] == [(16777216, 16777471, "AU")]
    names = "lang,very_active_wikipedians,active_wikipedians,other_contributors,admins,articles,redirects,edits_per_month,new_articles,fa_articles,new_fa_articles"
    (tmp_path / "s.csv").write_text(names + "\nxx,1,2,3,4,5,6,7,8,9,10     \n")
    assert tuple(read_summary(spark, str(tmp_path / "s.csv")).first()) == ("xx", 1, 2, 3, 4, 5, 6, 7, 8, 9, 10)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "x long, y string")
    append_result(df, str(tmp_path / "t"))
    append_result(df, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    write_metrics_csv(df, str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c"), header=True).columns == ["x", "y"]
    made = create_tables(spark, str(tmp_path / "tables"), "made_here")
    assert "revision" in made and spark.table("made_here.revision").count() == 0
    spark.sql("DROP DATABASE made_here CASCADE")


def test_config(tmp_path):
    (tmp_path / "c.ini").write_text("[base]\ndir = /d\n[job]\nlang = dewiki\ndumps_dir = ${base:dir}/x\ncompat_minor = yes\n")
    cfg = from_args(["--config", str(tmp_path / "c.ini"), "--lang", "frwiki"])
    assert (cfg.lang, cfg.dumps_dir, cfg.compat_minor, cfg.task) == ("frwiki", "/d/x", True, "history")


def test_revisions_stream_by(spark, tmp_path):
    """By the revision as by the page; pages without revisions; a cut end; a page of many revisions; 7z by a command."""
    one = lambda k, n: "".join(f"<revision><id>{k * 1000 + i}</id><timestamp>2010-01-01T00:00:{i % 60:02d}Z</timestamp><contributor><ip>1.2.3.4</ip></contributor><text xml:space=\"preserve\">t &lt;page&gt; {k} {i} é</text></revision>" for i in range(n))
    body = "<mediawiki>" + "".join(f"<page>\n<title>A &amp; B {k}</title><ns>0</ns><id>{k}</id>{one(k, n)}</page>" for k, n in ((1, 3), (2, 0), (3, 700), (4, 1)))
    p = tmp_path / "h.xml"
    p.write_text(body + "<page><title>cut</title><ns>0</ns><id>5</id><revision><id>9</id><text>lost", encoding="utf-8")
    raw = read_revisions_raw(spark, str(p))
    by_page = revisions(read_pages_raw(spark, str(p)), "enwiki").where("rev_page < 5")
    assert sorted(map(str, revisions(raw, "enwiki").collect())) == sorted(map(str, by_page.collect()))
    assert {(r.page_id, r.page_title) for r in pages(raw).collect()} == {(k, f"A & B {k}") for k in (1, 2, 3, 4)} | {(5, "cut")}
    assert corrupt_records(raw).count() == 1
    for suffix, pack in ((".xml.gz", gzip.compress), (".xml.bz2", bz2.compress), (".xml.xz", lzma.compress)):
        (tmp_path / f"h{suffix}").write_bytes(pack(p.read_bytes()))
        assert read_revisions_raw(spark, str(tmp_path / f"h{suffix}")).where("r.id is not null").count() == 704
    (tmp_path / "h.7z").write_bytes(gzip.compress(p.read_bytes()))  # any command that writes the content will do
    assert read_revisions_raw(spark, str(tmp_path / "h.7z"), ["gzip", "-dc", "--suffix=.7z"]).where("r.id is not null").count() == 704


def test_7z_only_as_a_last_resort(tmp_path):
    for name in ("x-pages-meta-history1.xml.7z", "x-pages-meta-history1.xml.bz2"):
        (tmp_path / name).touch()
        assert find_dumps(tmp_path, "history")[0].endswith(name[-3:])
    assert find_dumps(tmp_path, "history", True)[0].endswith(".7z")
