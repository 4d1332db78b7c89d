"""Writing tables: partitioned parquet, appended results, CSV lines, catalogue entries, with counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from editlume import schemas


def write_table(df: DataFrame, root: str, name: str, lang: str, mode: str = "overwrite", max_rows: int = 5_000_000) -> int:
    """One table of one wiki under root/name/lang=..; returns the rows written, counted while writing."""
    seen = Observation(name)
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode(mode).option("maxRecordsPerFile", max_rows).parquet(f"{root}/{name}/lang={lang}")
    return int(seen.get["rows"])


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """All wikis of a table, with the partition column lang."""
    return spark.read.parquet(f"{root}/{name}")


def append_result(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_metrics_csv(df: DataFrame, path: str) -> None:
    """A small result as one CSV file with a header naming every column."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def create_tables(spark: SparkSession, root: str, database: str | None = None) -> list[str]:
    """Catalogue entries for all tables, dropped and created anew; the files of earlier runs stay."""
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    made = []
    for name, columns in schemas.TABLES.items():
        full = f"`{database}`.`{name}`" if database else f"`{name}`"
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        spark.sql(f"CREATE TABLE {full} ({columns}, lang STRING) USING parquet PARTITIONED BY (lang) LOCATION '{root}/{name}'")
        made.append(name)
    return made


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once: the check that stands in for a primary key."""
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
