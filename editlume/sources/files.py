"""Finding, checking and reading the smaller inputs: dump folders, listings, digests, summaries, IP ranges."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editlume import schemas
from editlume.functions.ip import ipv4_to_long
from editlume.functions.text import hrefs

# The file names looked for, by task, in the order of preference.
PATTERNS: dict[str, tuple[str, ...]] = {
    "history": ("*pages-meta-history*.7z", "*pages-meta-history*.bz2", "*pages-meta-history*.xml"),
    "stub": ("*stub-meta-history*.gz", "*stub-meta-history*.xml"),
    "logging": ("*pages-logging*.gz", "*pages-logging*.xml"),
    "sql": ("*.sql.gz", "*.sql"),
}


def dump_dir(root: str, lang: str, date: str) -> Path:
    return Path(root).expanduser() / f"{lang}_dumps" / date


def find_dumps(folder: str | Path, task: str, decodes_7z: bool = False) -> list[str]:
    """The files of the first pattern that has any; 7z archives, unless they can be decoded, only where there is nothing else."""
    for pattern in sorted(PATTERNS[task], key=lambda p: p.endswith(".7z") and not decodes_7z):
        found = sorted(str(p) for p in Path(folder).glob(pattern))
        if found:
            return found
    raise FileNotFoundError(f"no {task} dumps in {folder}")


def listing_links(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Links of downloaded listing pages that match: path, href. Pages not marked as complete give none."""
    html = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")
    done = html.where(F.col("value").contains("Dump complete"))
    return done.select("path", F.explode(hrefs(F.col("value"), pattern)).alias("href"))


def fetch(urls: Sequence[str], get: Callable[[str], bytes], folder: str) -> list[str]:
    """Store what `get` returns for each address; the caller supplies the transport."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    out = []
    for url in urls:
        target = Path(folder) / url.rsplit("/", 1)[-1]
        target.write_bytes(get(url))
        out.append(str(target))
    return out


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = batch.column(0).to_pylist()
        found = []
        for path in paths:
            fs, at = pafs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
            h = hashlib.md5()
            with fs.open_input_stream(unquote(at)) as f:
                while chunk := f.read(1 << 20):
                    h.update(chunk)
            found.append(h.hexdigest())
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(found, pa.string())], names=["path", "actual"])


def verify_md5(spark: SparkSession, folder: str, manifest: str, glob: str = "*") -> DataFrame:
    """name, expected, actual, ok of each manifest line ('digest  name'); a missing file has actual NULL and ok false.

    Files of any size are read in chunks, a file a task, through the file system their address names.
    """
    line = spark.read.text(manifest).select(F.split(F.trim("value"), r"\s+").alias("p")).where(F.size("p") == 2)
    want = line.select(F.lower(F.get("p", F.lit(0))).alias("expected"), F.get("p", F.lit(1)).alias("name"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select("path")
    digests = files.repartition("path").mapInArrow(_digest, "path string, actual string")
    have = digests.select(F.element_at(F.split("path", "/"), -1).alias("name"), "actual")
    return want.join(have, "name", "left").withColumn("ok", F.coalesce(F.col("expected") == F.col("actual"), F.lit(False)))


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """The monthly summary by language (CSV with a header; blanks at line ends are dropped)."""
    return spark.read.csv(path, header=True, schema=schemas.SUMMARY_CSV, ignoreTrailingWhiteSpace=True, ignoreLeadingWhiteSpace=True)


def read_ip_ranges(spark: SparkSession, path: str) -> DataFrame:
    """lo, hi, country from quoted CSV lines without a header; lines that are no IPv4 range are left out."""
    raw = spark.read.csv(path, schema=schemas.IP_RANGE_CSV, quote='"')
    return raw.select(ipv4_to_long(F.col("from_ip")).alias("lo"), ipv4_to_long(F.col("to_ip")).alias("hi"), "country").where("lo is not null and hi is not null")


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int, partitions: int, **options: str) -> DataFrame:
    """A database table, read in `partitions` ranges of a numeric key."""
    return spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=key, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(partitions), **options
    ).load()
