"""Queries of the text problems (3, 7, 8, 9) and the SQL of those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editlume.llm.leakage import find_leaks
from editlume.llm.mixing import count_tokens, mix_sources
from editlume.llm.near_dups import expand_pairs, near_duplicate_classes, near_duplicate_groups
from editlume.llm.prose import flag_pages
from editlume.operators.skew import heavy_join
from editlume.session import materialize, table

TOKENIZERS = os.environ.get("EDITLUME_TOKENIZERS", "/opt/tokenizers")
RANKS = "byte_bpe_multi_50k.tiktoken"
# the pre-tokenizer of the public byte-level BPE vocabularies (fixed value)
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
P3 = {"shingle": 3, "threshold": 0.6, "min_words": 20}


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "revision").select("rev_id", "text")


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    found = near_duplicate_classes(_texts(spark, sf), "rev_id", "text", **P3)
    return expand_pairs(*found).select(F.col("a").alias("rev_id_a"), F.col("b").alias("rev_id_b"))


def p3_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Per revision: its group, the number of equal copies, and the stored hash, which could show only the copies."""
    found = near_duplicate_groups(_texts(spark, sf), "rev_id", "text", **P3)
    stored = table(spark, sf, "revision_hash").groupBy("rev_id").agg(F.max(F.lower("rev_hash")).alias("rev_hash"))
    return found.join(stored, found["id"] == stored["rev_id"], "left").select(F.col("id").alias("rev_id"), "group_id", "n_copies", "rev_hash")


def _leaks(spark: SparkSession, sf: str) -> DataFrame:
    return find_leaks(table(spark, sf, "documents"), table(spark, sf, "heldout_item"))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return _leaks(spark, sf).select("doc_id", "item_id")


def p7_leaks(spark: SparkSession, sf: str) -> DataFrame:
    return _leaks(spark, sf)


def _mix(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Topic: the namespace of the document's page, as far as it has one."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "source", "lang", "page_id")
    page = table(spark, sf, "page").where("page_id is not null").groupBy(F.col("page_id").alias("pid")).agg(F.max("page_namespace").alias("topic"))
    sized = materialize(count_tokens(docs, "text", f"{TOKENIZERS}/{RANKS}", PATTERN), "token-counts")
    topical = heavy_join(sized, page, "page_id", "pid", ["topic"])
    return mix_sources(topical, table(spark, sf, "mix_target"), "doc_id")


def p8_mix(spark: SparkSession, sf: str) -> DataFrame:
    return _mix(spark, sf)[0]


def p8_shares(spark: SparkSession, sf: str) -> DataFrame:
    return _mix(spark, sf)[1]


def p8_margins(spark: SparkSession, sf: str) -> DataFrame:
    return _mix(spark, sf)[2]


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return p9_scores(spark, sf).where("flagged").select("doc_id")


def p9_scores(spark: SparkSession, sf: str) -> DataFrame:
    return flag_pages(table(spark, sf, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p3_found, p3_groups, p7_found, p7_leaks, p8_mix, p8_shares, p8_margins, p9_found, p9_scores)}
# p7: DuckDB has no NFKC; NFC gives the same words wherever a text holds no compatibility characters that matter to a case
SQL: dict[str, str] = {
    "p3_found": """WITH t AS (SELECT rev_id, max(text) AS text FROM revision WHERE rev_id IS NOT NULL AND text IS NOT NULL GROUP BY rev_id),
w AS (SELECT rev_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM t),
s AS (SELECT DISTINCT rev_id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g FROM w WHERE len(w) >= 20),
c AS (SELECT rev_id, count(*) AS n FROM s GROUP BY rev_id),
p AS (SELECT a.rev_id AS x, b.rev_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.rev_id < b.rev_id GROUP BY 1, 2)
SELECT x AS rev_id_a, y AS rev_id_b FROM p JOIN c cx ON cx.rev_id = x JOIN c cy ON cy.rev_id = y WHERE 10 * k >= 6 * (cx.n + cy.n - k)""",
    "p3_groups": """WITH RECURSIVE t AS (SELECT rev_id, max(text) AS text FROM revision WHERE rev_id IS NOT NULL AND text IS NOT NULL GROUP BY rev_id),
w AS (SELECT rev_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM t),
long AS (SELECT rev_id, w, count(*) OVER (PARTITION BY w) AS n_copies FROM w WHERE len(w) >= 20),
s AS (SELECT DISTINCT rev_id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g FROM long),
c AS (SELECT rev_id, count(*) AS n FROM s GROUP BY rev_id),
p AS (SELECT a.rev_id AS x, b.rev_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.rev_id < b.rev_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN c cx ON cx.rev_id = x JOIN c cy ON cy.rev_id = y WHERE 10 * k >= 6 * (cx.n + cy.n - k)),
both_ways AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
reach AS (SELECT rev_id AS x, rev_id AS y FROM long UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON b.x = r.y),
least AS (SELECT x, min(y) AS group_id FROM reach GROUP BY x),
h AS (SELECT rev_id, max(lower(rev_hash)) AS rev_hash FROM revision_hash GROUP BY rev_id)
SELECT l.rev_id, group_id, n_copies, rev_hash FROM long l JOIN least ON least.x = l.rev_id LEFT JOIN h ON h.rev_id = l.rev_id""",
    "p7_found": """WITH t AS (SELECT 'd' AS kind, doc_id AS id, text FROM documents WHERE text IS NOT NULL UNION ALL SELECT 'i', item_id, text FROM heldout_item WHERE text IS NOT NULL),
w AS (SELECT kind, id, regexp_extract_all(lower(nfc_normalize(regexp_replace(text, '\\p{Cf}', '', 'g'))), '[\\p{L}\\p{N}]+') AS w FROM t),
g3 AS (SELECT DISTINCT kind, id, unnest(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) AS g FROM w),
g12 AS (SELECT DISTINCT kind, id, unnest(list_transform(range(1, len(w) - 10), lambda i: array_to_string(w[i:i + 11], ' '))) AS g FROM w WHERE len(w) >= 12),
n AS (SELECT id, count(*) AS n FROM g3 WHERE kind = 'i' GROUP BY id),
half AS (SELECT d.id AS doc_id, i.id AS item_id FROM g3 d JOIN g3 i ON d.g = i.g AND d.kind = 'd' AND i.kind = 'i' JOIN n ON n.id = i.id GROUP BY d.id, i.id, n.n HAVING 2 * count(*) >= n.n),
run AS (SELECT DISTINCT d.id AS doc_id, i.id AS item_id FROM g12 d JOIN g12 i ON d.g = i.g AND d.kind = 'd' AND i.kind = 'i')
SELECT doc_id, item_id FROM half UNION SELECT doc_id, item_id FROM run""",
}
