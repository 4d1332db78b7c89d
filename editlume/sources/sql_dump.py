"""mysqldump files: the INSERT lines of one table as a typed frame."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from editlume.schemas import SQL_DUMPS
from editlume.session import ship_package

_ESCAPES = {"0": "\0", "n": "\n", "r": "\r", "t": "\t", "b": "\b", "Z": "\x1a"}


# a quoted string (with an optional charset mark), a bare value, or an end of a value or row
_TOKEN = re.compile(r"(?:_binary\s*)?'((?:[^'\\]|\\.|'')*)'|([^\s'(),;][^'(),;]*)|([(),])", re.S | re.I)
_ESCAPED = re.compile(r"\\(.)|''", re.S)


def _plain(m: re.Match[str]) -> str:
    return "'" if m[1] is None else _ESCAPES.get(m[1], m[1])


def insert_tuples(line: str) -> Iterator[list[str | None]]:
    """The value tuples of one INSERT line: quoted strings unescaped, NULL as None, the rest as written; one token at a time."""
    at = line.find("VALUES")
    if at < 0:
        return
    row: list[str | None] | None = None
    value: str | None = None
    for m in _TOKEN.finditer(line, at + len("VALUES")):
        quoted, bare, mark = m.groups()
        if mark == "(":
            row, value = [], ""
        elif row is None:
            continue
        elif mark:
            row.append(value)
            value = ""
            if mark == ")":
                yield row
                row = None
        elif quoted is not None:
            value = _ESCAPED.sub(_plain, quoted) if "\\" in quoted or "''" in quoted else quoted
        else:
            value = None if bare.strip().upper() == "NULL" else bare.strip()


def read_sql_dump(spark: SparkSession, path: str, table: str, schema: str | None = None) -> DataFrame:
    """All rows inserted into `table` by the dump at `path` (.sql, or .gz/.bz2 by Spark's codecs).

    Lines are independent, so files are split wherever their codec allows. Columns beyond the schema
    are dropped, missing ones are NULL, values that do not fit their type are NULL.
    """
    target: T.StructType = T._parse_datatype_string(schema or SQL_DUMPS[table])  # type: ignore[assignment]
    names = target.fieldNames()
    ship_package(spark)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for line in batch.column(0).to_pylist():
                rows = [(r + [None] * len(names))[: len(names)] for r in insert_tuples(line)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=names)

    lines = spark.read.text(path).where(F.col("value").startswith(f"INSERT INTO `{table}`") | F.col("value").startswith(f"INSERT INTO {table} "))
    text = lines.mapInArrow(parse, ", ".join(f"`{n}` string" for n in names))
    return text.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in target])
