"""Whole loads: a wiki's dumps to tables."""

from __future__ import annotations

import sys
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import SparkSession

from editlume.config import JobConfig, from_args
from editlume.functions.patterns import check_wiki
from editlume.operators.logsplit import split_log
from editlume.session import build_session, drop_materialized, materialize
from editlume.sources.files import dump_dir, find_dumps
from editlume.sources.sinks import write_table
from editlume.sources.sql_dump import read_sql_dump
from editlume.sources.xml_dump import history_tables, logitems, pages, read_namespaces, read_revisions_raw, revisions
from editlume.schemas import SQL_DUMPS


def revision_history(spark: SparkSession, cfg: JobConfig, decoder: Sequence[str] = ()) -> dict[str, int]:
    """page, namespaces, revision, revision_hash, revision_ip, user, revision_user_zero; rows written by table.

    The dumps are read once, by the revision, into a table of the shared folder; all else reads that.
    """
    check_wiki(cfg.lang)
    paths = find_dumps(dump_dir(cfg.dumps_dir, cfg.lang, cfg.date), "history" if cfg.task == "history" else "stub", bool(decoder))
    staged = materialize(read_revisions_raw(spark, paths, decoder), "raw-revisions")
    parsed = materialize(revisions(staged, cfg.lang, cfg.compat_minor), "parsed-revisions")
    tables = {"page": pages(staged), "namespaces": read_namespaces(spark, paths[0], decoder), **history_tables(parsed)}
    out = {name: write_table(df, cfg.output, name, cfg.lang, max_rows=cfg.max_rows_per_file) for name, df in tables.items()}
    drop_materialized(parsed)
    drop_materialized(staged)
    return out


def page_logging(spark: SparkSession, cfg: JobConfig) -> dict[str, int]:
    """logging, block, user_new, user_level from all log dumps found."""
    paths = find_dumps(dump_dir(cfg.dumps_dir, cfg.lang, cfg.date), "logging")
    names = {r["name"]: r["code"] for r in read_namespaces(spark, paths[0]).collect()}
    items = materialize(logitems(spark, paths), "log-items")
    out = {name: write_table(df, cfg.output, name, cfg.lang, max_rows=cfg.max_rows_per_file) for name, df in split_log(items, names).items()}
    drop_materialized(items)
    return out


def sql_dumps(spark: SparkSession, cfg: JobConfig) -> dict[str, int]:
    """Every known table among the SQL dumps found."""
    out = {}
    for path in find_dumps(dump_dir(cfg.dumps_dir, cfg.lang, cfg.date), "sql"):
        stem = Path(path).name.removesuffix(".gz").removesuffix(".sql")
        known = max((t for t in SQL_DUMPS if stem == t or stem.endswith("-" + t)), key=len, default=None)
        if known:
            out[known] = write_table(read_sql_dump(spark, path, known), cfg.output, known, cfg.lang, max_rows=cfg.max_rows_per_file)
    return out


JOBS = {"history": revision_history, "stub": revision_history, "logging": page_logging, "sql": sql_dumps}

if __name__ == "__main__":
    config = from_args(sys.argv[1:])
    print(JOBS[config.task](build_session(), config))
