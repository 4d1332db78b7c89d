"""References to records that do not exist: a balance of signed reference and existence counts per key, kept by merging change deltas."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editlume.session import materialize

#: Keys with at least this share of a field's references are joined by broadcast: at most 100 a field.
HOT = 0.01


@dataclass(frozen=True)
class Reference:
    """A field that refers to the key of a target table; values in `no_reference` (and NULL) refer to nothing.

    A `target` of None is the table of the referring records itself, whose key is their id.
    """

    field: str
    target: DataFrame | None
    target_key: str
    target_name: str
    no_reference: Sequence[int] = ()


def _refers(ref: Reference) -> Column:
    there = F.col(ref.field).isNotNull()
    return there & ~F.col(ref.field).isin(list(ref.no_reference)) if ref.no_reference else there


def cited(once: DataFrame, references: Sequence[Reference], keep: Sequence[str] = ()) -> DataFrame:
    """(field, key, first_loaded, ...): one row per record and field that refers to something, in one scan."""
    each = [F.when(_refers(r), F.struct(F.lit(r.field).alias("field"), F.col(r.field).cast("long").alias("key"))) for r in references]
    return once.select("first_loaded", *keep, F.explode(F.array_compact(F.array(*each))).alias("_r")).select("_r.field", "_r.key", "first_loaded", *keep)


def reference_deltas(once: DataFrame, references: Sequence[Reference], sign: int = 1) -> DataFrame:
    """Deltas of records loaded (sign 1) or withdrawn (-1)."""
    load = F.col("first_loaded") if sign > 0 else F.lit(None).cast("timestamp_ntz")
    return _delta(cited(once, references), d_ref=F.lit(sign), ref_loaded=load)


def existence_deltas(targets: DataFrame, field: str, key: str, loaded: str | None = None, sign: int = 1) -> DataFrame:
    """Deltas of distinct target rows loaded or restored (sign 1), or removed (-1)."""
    when = F.min(loaded).cast("timestamp_ntz") if loaded else F.lit(None).cast("timestamp_ntz")
    rows = targets.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("key")).agg(when.alias("when"))
    return _delta(rows.withColumn("field", F.lit(field)), d_exist=F.lit(sign), d_removed=F.lit(int(sign < 0)), target_loaded=F.col("when"))


def _delta(rows: DataFrame, **given: Column) -> DataFrame:
    counts = [given.get(c, F.lit(0)).cast("long").alias(c) for c in ("d_ref", "d_exist", "d_removed")]
    times = [given.get(c, F.lit(None)).cast("timestamp_ntz").alias(c) for c in ("ref_loaded", "target_loaded")]
    return rows.select("field", "key", *counts, *times)


def change_deltas(once: DataFrame, once_id: str, references: Sequence[Reference], loaded: str, removed: DataFrame) -> DataFrame:
    """The deltas that have led to the present tables: (field, key, d_ref, d_exist, d_removed, ref_loaded, target_loaded).

    A record is +1 reference of each key it refers to, a target row in its table +1 existence. A row
    listed as removed had been created (+1) and was removed (-1); if it was restored since, its table
    holds the +1 of the restoration. All are pre-aggregated before they are shuffled.
    """
    out = reference_deltas(once, references)
    for ref in references:
        target, key, when = (once, once_id, "first_loaded") if ref.target is None else (ref.target, ref.target_key, loaded)
        gone = removed.where(F.col("ref_table") == ref.target_name)
        for part in (existence_deltas(target, ref.field, key, when), existence_deltas(gone, ref.field, "row_key"), existence_deltas(gone, ref.field, "row_key", None, -1)):
            out = out.unionByName(part)
    return out


def merge(balance: DataFrame | None, deltas: DataFrame) -> DataFrame:
    """The balance (field, key, n_ref, n_exist, n_removed, ref_loaded, target_loaded) after the deltas; None is an empty one.

    Sums and minima: batches may be merged in any order and number, with the same outcome as one run
    over all. A batch brings each record and each change once.
    """
    names = {"d_ref": "n_ref", "d_exist": "n_exist", "d_removed": "n_removed"}
    rows = deltas.withColumnsRenamed(names)
    if balance is not None:
        rows = balance.unionByName(rows)
    return rows.groupBy("field", "key").agg(*[F.sum(c).alias(c) for c in names.values()], F.min("ref_loaded").alias("ref_loaded"), F.min("target_loaded").alias("target_loaded"))


def faulty_keys(balance: DataFrame) -> DataFrame:
    """Keys with positive references and no existence (`deleted` or `missing`), or first loaded after a reference (`late`)."""
    gone = F.when(F.col("n_removed") > 0, "deleted").otherwise("missing")
    kind = F.when(F.col("n_exist") <= 0, gone).when(F.col("target_loaded") > F.col("ref_loaded"), "late")
    return balance.where("n_ref > 0").select("field", "key", "n_ref", kind.alias("kind"), "target_loaded").where("kind is not null")


def orphan_references(refs: DataFrame, ref_id: str, period_of: str, loaded: str, references: Sequence[Reference], removed: DataFrame) -> DataFrame:
    """One row per referring record and field whose target is absent or came later: id, ref_field, kind, period.

    `kind`: `deleted` (target absent, listed as removed), `missing` (absent otherwise), `late`
    (target there, first loaded after the record's own first load). Rows repeated under one id
    count once: the largest value of each field and the earliest load hold. NULL refers to nothing,
    as do a field's `no_reference` values. `period` is the month of `period_of`, NULL if that is.
    Extra columns are ignored. The balance is a table in the shared folder; only its faulty keys meet
    the records, hot keys by a broadcast that their share of the references bounds.
    """
    fields = list(dict.fromkeys(r.field for r in references))
    folded = (
        refs.where(F.col(ref_id).isNotNull())
        .groupBy(F.col(ref_id).alias("_id"))
        .agg(*[F.max(f).alias(f) for f in fields], F.max(period_of).alias("_when"), F.min(loaded).cast("timestamp_ntz").alias("first_loaded"))
    )
    once = materialize(folded, "references")  # narrow, and read again
    balance = materialize(merge(None, change_deltas(once, "_id", references, loaded, removed)), "reference-balance")
    faulty = faulty_keys(balance)
    total = balance.groupBy("field").agg(F.sum("n_ref").alias("_all"))
    hot = balance.join(F.broadcast(total), "field").where(F.col("n_ref") >= F.greatest(HOT * F.col("_all"), F.lit(1))).select("field", "key")
    verdicts = F.broadcast(hot.join(faulty.select("field", "key", "kind", "target_loaded"), ["field", "key"], "left").withColumn("_hot", F.lit(True)))
    marked = cited(once, references, ["_id", "_when"]).join(verdicts, ["field", "key"], "left")
    own = ["_id", "_when", "first_loaded", "field", "key"]
    few = marked.where("_hot is null").select(*own).join(faulty.select("field", "key", "kind", "target_loaded"), ["field", "key"])
    found = marked.where("_hot and kind is not null").select(*own, "kind", "target_loaded").unionByName(few.select(*own, "kind", "target_loaded"))
    found = found.where((F.col("kind") != "late") | (F.col("target_loaded") > F.col("first_loaded")))
    return found.select(F.col("_id").alias(ref_id), F.col("field").alias("ref_field"), "kind", F.date_format("_when", "yyyy-MM").alias("period"))


def orphan_report(found: DataFrame) -> DataFrame:
    """Counts per field, kind and period."""
    return found.groupBy("ref_field", "kind", "period").agg(F.count("*").alias("n_refs"))
