"""Page-history and log dumps in XML: plain, gz and bz2 by Spark's codecs, xz, lzma and (by a given command) 7z as streams.

Histories are read by the revision: a page's history may be larger than a row or an executor's memory.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from typing import IO
from xml.sax.saxutils import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editlume import schemas
from editlume.functions import revision as R
from editlume.session import ship_package

_CHUNK = 1 << 20
_BATCH = 4 << 20
OPTIONS = {"ignoreSurroundingSpaces": "false", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}


@contextmanager
def _stream(path: str, decoder: Sequence[str]) -> Iterator[IO[bytes]]:
    """The decompressed bytes of a file; a .7z is read from the output of `decoder` followed by its path."""
    path = path.removeprefix("file://").removeprefix("file:")
    if path.endswith(".7z"):
        import subprocess

        with subprocess.Popen([*decoder, path], stdout=subprocess.PIPE) as run:
            yield run.stdout
        if run.returncode:
            raise OSError(f"{decoder[0]} ended with {run.returncode} on {path}")
        return
    module = {"gz": "gzip", "bz2": "bz2", "xz": "lzma", "lzma": "lzma"}.get(path.rsplit(".", 1)[-1], "io")
    with __import__(module).open(path, "rb") as f:
        yield f


def _pieces(f: IO[bytes], token: re.Pattern[bytes]) -> Iterator[tuple[bytes, bytes]]:
    """(token, what came before it since the last one) through the stream, ended by (b'', the rest); every byte is searched once."""
    held, searched = b"", 0
    while chunk := f.read(_CHUNK):
        held += chunk
        at = 0
        for m in token.finditer(held, searched):
            yield m[0], held[at : m.start()]
            at = m.end()
        held = held[at:]
        searched = max(0, len(held) - 32)  # a token may be cut by the end of the chunk
    yield b"", held


def _records(spark: SparkSession, paths: Sequence[str], tag: str, decoder: Sequence[str] = ()) -> DataFrame:
    """One row (`record`) per <tag> element, decompressed as a stream by one task per file."""
    ship_package(spark)
    name = re.escape(tag.encode())
    token = re.compile(rb"<%s(?=[\s>])|</%s>" % (name, name))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                found, size = [], 0
                with _stream(path, decoder) as f:
                    for mark, before in _pieces(f, token):
                        if mark.startswith(b"</"):
                            found.append((b"<" + tag.encode() + before + mark).decode("utf-8", "replace"))
                            size += len(before)
                            if size >= _BATCH:
                                yield pa.RecordBatch.from_arrays([pa.array(found)], names=["record"])
                                found, size = [], 0
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(found)], names=["record"])

    files = spark.createDataFrame([(p,) for p in paths], "path string").repartition(len(paths), "path")
    return files.mapInArrow(split, "record string")


def read_revisions_raw(spark: SparkSession, paths: Sequence[str] | str, decoder: Sequence[str] = ()) -> DataFrame:
    """(page_id, ns, title, restrictions, opens, parent_id, r): one row per revision, as it streams by.

    A task holds one revision at a time, so a page of any size is read; r is the parsed element, parent_id
    the id of the revision before in the page. `opens` marks the first row of each page; a page without
    revisions has one row, with r NULL. A revision cut off by the end of the file is kept as a corrupt r without id.
    A file is one task (dumps come in many); 7z archives need a `decoder`, a command that writes the
    content of the archive named after it to its output, present on every worker.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    _refuse(paths, decoder)
    ship_package(spark)
    token = re.compile(rb"</?(?:page|revision)>")
    schema = "page_id long, ns int, title string, restrictions string, opens boolean, parent_id long, record string"
    names = [c.split()[0] for c in schema.split(", ")]
    types = [pa.int64(), pa.int32(), pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.string()]

    def one(head: bytes, tag: bytes) -> str | None:
        m = re.search(rb"<%s>(.*?)</%s>" % (tag, tag), head, re.S)
        return unescape(m[1].decode("utf-8", "replace"), {"&quot;": '"', "&apos;": "'", "&#039;": "'"}) if m else None

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows: list[tuple] = []
                size, page, parent, opens, inside = 0, (None, None, None, None), None, False, False
                with _stream(path, decoder) as f:
                    for mark, before in _pieces(f, token):
                        if opens and not inside and mark in (b"<revision>", b"</page>"):
                            ident, ns = one(before, b"id"), one(before, b"ns")
                            page = (int(ident) if ident else None, int(ns) if ns else None, one(before, b"title"), one(before, b"restrictions"))
                        if mark == b"<page>":
                            parent, opens = None, True
                        elif mark == b"</page>" and opens:
                            rows.append((*page, True, None, None))
                            opens = False
                        elif mark == b"</revision>" or not mark and inside:
                            rows.append((*page, opens, parent, f"<revision>{before.decode('utf-8', 'replace')}" + "</revision>" * bool(mark)))
                            m = re.search(rb"<id>(\d+)</id>", before)
                            parent, opens = int(m[1]) if m else None, False
                            size += len(before)
                        inside = mark == b"<revision>"
                        if size >= _BATCH:
                            yield batch_of(rows)
                            rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.createDataFrame([(p,) for p in paths], "path string").repartition(len(paths), "path")
    parsed = F.from_xml("record", schemas.REVISION_XML, {"rowTag": "revision", **OPTIONS})
    return files.mapInArrow(split, schema).select(*names[:-1], parsed.alias("r"))


def _refuse(paths: Sequence[str], decoder: Sequence[str]) -> None:
    packed = [p for p in paths if p.endswith(".7z")]
    if packed and not decoder:
        raise ValueError(f"7z archives need a decoder command, or conversion (for example to bz2): {packed}")


def _read(spark: SparkSession, paths: Sequence[str] | str, tag: str, schema: str, decoder: Sequence[str] = ()) -> DataFrame:
    paths = [paths] if isinstance(paths, str) else list(paths)
    _refuse(paths, decoder)
    streamed = (".xz", ".lzma", ".7z")
    packed = [p for p in paths if p.endswith(streamed)]
    plain = [p for p in paths if not p.endswith(streamed)]
    out: DataFrame | None = None
    if plain:
        out = (
            spark.read.format("xml").options(rowTag=tag, **OPTIONS).schema(schema).load(",".join(plain))
        )
    if packed:
        part = _records(spark, packed, tag, decoder).select(F.from_xml("record", schema, {"rowTag": tag, **OPTIONS}).alias("_r")).select("_r.*")
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no input files")
    return out


def read_namespaces(spark: SparkSession, path: str, decoder: Sequence[str] = ()) -> DataFrame:
    """code, name; the main namespace has the name ''."""
    return _read(spark, path, "namespace", schemas.NAMESPACE_XML, decoder).select(F.col("_key").cast("short").alias("code"), F.coalesce("_VALUE", F.lit("")).alias("name"))


def read_pages_raw(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """One row per page with all its revisions: for dumps whose pages are known to be small."""
    return _read(spark, paths, "page", schemas.PAGE_XML)


def corrupt_records(raw: DataFrame) -> DataFrame:
    """The records that could not be parsed (or had no id)."""
    if "opens" in raw.columns:
        return raw.where("r is not null and (r.id is null or r._corrupt is not null)").select("r._corrupt")
    return raw.where("id is null or _corrupt is not null").select("_corrupt")


def pages(raw: DataFrame) -> DataFrame:
    """The page rows of either raw form."""
    if "opens" in raw.columns:
        raw = raw.where("opens").withColumnRenamed("page_id", "id")
    return raw.where("id is not null").select(
        F.col("id").alias("page_id"), F.col("ns").cast("short").alias("page_namespace"), F.col("title").alias("page_title"), F.col("restrictions").alias("page_restrictions")
    )


def revisions(raw: DataFrame, wiki: str, compat_minor: bool = False, keep_text: bool = False) -> DataFrame:
    """One row per revision with all derived columns; ip_text, username and rev_hash come along for the other tables.

    The parent is the revision before in document order within the page. `raw` is by page or by
    revision; metadata-only dumps give length 0 and the digest of ''.
    """
    if "opens" in raw.columns:
        r = raw.where("page_id is not null and r.id is not null").select(
            F.col("page_id").alias("rev_page"), F.col("ns").alias("_ns"), F.col("r").withField("parent_id", F.col("parent_id")).alias("r")
        )
    else:
        r = raw.where("id is not null").select(
            F.col("id").alias("rev_page"), F.col("ns").alias("_ns"), F.explode(R.with_parents(F.col("revision"))).alias("r")
        )
    text = F.col("r.text._VALUE")
    ip, uid, name = F.col("r.contributor.ip"), F.col("r.contributor.id"), F.col("r.contributor.username")
    flags = R.status_flags(text, F.col("_ns"), wiki)
    return r.select(
        F.col("r.id").alias("rev_id"), "rev_page", R.editor_id(ip, uid, name).alias("rev_user"), R.iso_timestamp(F.col("r.timestamp")).alias("rev_timestamp"),
        R.byte_length(text).alias("rev_len"), F.col("r.parent_id").alias("rev_parent_id"), flags["rev_is_redirect"].alias("rev_is_redirect"),
        R.minor_edit(F.col("r.minor"), compat_minor).alias("rev_minor_edit"), flags["rev_fa"].alias("rev_fa"), flags["rev_flist"].alias("rev_flist"),
        flags["rev_ga"].alias("rev_ga"), F.col("r.comment").alias("rev_comment"), R.text_digest(text).alias("rev_hash"), ip.alias("ip_text"), name.alias("username"),
        *([text.alias("text")] if keep_text else []),
    )


def history_tables(parsed: DataFrame) -> dict[str, DataFrame]:
    """revision, revision_hash, revision_ip, user and revision_user_zero from parsed revisions (write those first)."""
    cols = [c.split()[0] for c in schemas.TABLES["revision"].split(", ")]
    named = parsed.where("rev_user > 0").groupBy(F.col("rev_user").alias("user_id")).agg(
        F.coalesce(F.max_by("username", F.when(F.col("username").isNotNull(), F.struct("rev_timestamp", "rev_id"))), F.lit("")).alias("user_name")
    )
    pseudo = parsed.sparkSession.createDataFrame(list(R.PSEUDO_USERS), "user_id long, user_name string")
    return {
        "revision": parsed.select(*cols),
        "revision_hash": parsed.select("rev_id", "rev_page", "rev_user", "rev_hash"),
        "revision_ip": parsed.where("rev_user = 0").select("rev_id", "ip_text", R.anonymous_ip(F.col("ip_text")).alias("ip_v4")),
        "user": named.unionByName(pseudo),
        "revision_user_zero": parsed.where("rev_user = -2").select("rev_id", F.col("username").alias("user_name")),
    }


def logitems(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """Log entries of all files in the shape `split_log` takes."""
    raw = _read(spark, paths, "logitem", schemas.LOGITEM_XML).where("id is not null")
    return raw.select(
        "id", R.iso_timestamp(F.col("timestamp")).alias("timestamp"), F.col("contributor.id").alias("user_id"), F.col("contributor.username").alias("username"),
        "comment", "type", "action", F.col("logtitle").alias("title"), F.col("params._VALUE").alias("params"),
    )
