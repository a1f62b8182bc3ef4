"""Change feeds: a snapshot plus changes gives the current rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from relata.operators.dedupe import first_per_key

# The change operations. A change row is the source's columns plus these two.
INSERT, UPDATE, DELETE = "I", "U", "D"
OP, SEQ = "op", "seq"


def last_changes(changes: DataFrame, key: Sequence[str], order: str = SEQ) -> DataFrame:
    """The last change per key; a delete wins over other changes of the same sequence number."""
    rest = [F.col(name).asc_nulls_last() for name in changes.columns if name not in {*key, order, OP}]
    return first_per_key(changes, list(key), [F.col(order).desc_nulls_last(), F.col(OP).asc(), *rest])


def _met(base: DataFrame, last: DataFrame, key: Sequence[str]) -> DataFrame:
    """Base rows and last changes side by side: structs ``_base`` and ``_change``, one of them NULL where a key has one only."""
    old = base.select(F.struct(*base.columns).alias("_base"))
    new = last.select(F.struct(*last.columns).alias("_change"))
    same = [F.col(f"_base.{name}").eqNullSafe(F.col(f"_change.{name}")) for name in key]
    return old.join(new, reduce(and_, same), "full_outer")


def apply_changes(snapshot: DataFrame, changes: DataFrame, key: Sequence[str], order: str = SEQ) -> DataFrame:
    """Current row per key: untouched snapshot rows, and the last change of each changed key unless a delete.

    The feed is ranked once and the snapshot, which has one row per key, is read once.
    """
    met = _met(snapshot, last_changes(changes, key, order), key)
    changed = F.col("_change").isNotNull()
    kept = met.where(~changed | (F.col(f"_change.{OP}") != DELETE))
    return kept.select(*[F.when(changed, F.col(f"_change.{n}")).otherwise(F.col(f"_base.{n}")).alias(n) for n in snapshot.columns])


def as_base(snapshot: DataFrame) -> DataFrame:
    """A backfilled snapshot in change form: older than any change."""
    return snapshot.withColumns({OP: F.lit(INSERT), SEQ: F.lit(None).cast("bigint")})


def merge_changes(base: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """``base`` with changes merged, both in change form, deletes kept as marks.

    The marks and sequence numbers let a change that arrives late lose against what is already merged. The feed is
    ranked once and the base, which has one row per key, is read once; of both rows of a key the one that
    ``last_changes`` would rank first stays.
    """
    met = _met(base, last_changes(changes, key), key)
    rest = [name for name in base.columns if name not in {*key, SEQ, OP}]

    def rank(side: str) -> Column:
        """Less is first: known sequence numbers before NULL, the greater ones first, then operation and values."""
        values = [part for name in (OP, *rest) for part in (F.col(f"{side}.{name}").isNull(), F.col(f"{side}.{name}"))]
        seq = F.col(f"{side}.{SEQ}")
        return F.struct(seq.isNull(), -seq, *values)

    older = F.col("_base").isNull() | (F.col("_change").isNotNull() & (rank("_change") < rank("_base")))
    return met.select(*[F.when(older, F.col(f"_change.{n}")).otherwise(F.col(f"_base.{n}")).alias(n) for n in base.columns])


def live_rows(base: DataFrame) -> DataFrame:
    return base.where(F.col(OP) != DELETE).drop(OP, SEQ)


def insert_missing(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """Target rows plus the source rows whose key the target lacks; present rows are left as they are."""
    new = source.join(target.select(*key).distinct(), list(key), "left_anti")
    return target.unionByName(new.select(*target.columns))
