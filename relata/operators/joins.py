"""Joins by normalised keys, missing-partner tests and a join that survives a hot key on either side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from relata.functions.text import is_blank, trimmed
from relata.sinks.scratch import stored

#: Right rows of one key that a join meets in one place; a key with more is dealt into parts.
PART_ROWS = 1_000_000
#: Places of a sieve of keys. It has a row for 64 places, 131,072 rows at most, however many keys there are.
SIEVE_BITS = 23


def apart(key: str) -> list[Column]:
    """Grouping columns for the keys of a right side that is joined on ``key``.

    Grouped by the key and its hash, the right side lies otherwise than the join needs and is shuffled once more. Both
    sides of the join are then plain shuffles, and adaptive execution can split a key that holds many left rows, NULL and
    blank ones included. Grouped by the key alone, the aggregate would stand between shuffle and join and forbid that.
    """
    return [F.col(key), F.xxhash64(key).alias("_apart")]


def known_keys(dimension: DataFrame, key: str) -> DataFrame:
    """The distinct trimmed keys of a dimension as ``_key``."""
    keys = dimension.where(~is_blank(key)).select(trimmed(key).alias("_key"))
    return keys.groupBy(*apart("_key")).agg(F.count(F.lit(1)).alias("_rows")).select("_key")


def key_counts(fact: DataFrame, key: str) -> DataFrame:
    """Rows per trimmed key, blank keys left out; map-side combined, so hot keys stay cheap."""
    return (
        fact.where(~is_blank(key))
        .groupBy(trimmed(key).alias("_key"))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )


def orphan_count(fact: DataFrame, users: DataFrame, key: str = "user_id", dimension_key: str = "user_id") -> DataFrame:
    """How many rows ``orphans`` has, shuffling one row per key and map task."""
    missing = key_counts(fact, key).join(known_keys(users, dimension_key), "_key", "left_anti")
    return missing.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("orphan_rows"))


def missing_keys(fact: DataFrame, users: DataFrame, key: str, dimension_key: str) -> DataFrame:
    """The distinct keys of a fact table that the dimension lacks, as a stored table ``_key``.

    Only the key column of the fact is read, and one row per key and map task is shuffled.
    """
    missing = key_counts(fact, key).join(known_keys(users, dimension_key), "_key", "left_anti")
    return stored(missing.select("_key"), "missing-keys")


def _place(key: Column | str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << SIEVE_BITS))


def sieved(rows: DataFrame, key: str, keys: DataFrame, flag: str) -> DataFrame:
    """``rows`` with the column ``flag``: may the text column ``key`` be one of ``keys``? False is certain.

    The keys' hashes are bits of a table of bounded size, which is sent to all rows where they are.
    """
    held = keys.select(_place("_key").alias("_at")).groupBy((F.shiftright("_at", 6)).alias("_word"))
    bit = F.expr("bit_or(shiftleft(bigint(1), int(_at & 63)))")
    words = F.broadcast(held.agg(bit.alias("_bits")))
    found = rows.withColumn("_at", _place(key)).withColumn("_word", F.shiftright("_at", 6)).join(words, "_word", "left")
    hit = F.expr("(shiftrightunsigned(_bits, int(_at & 63)) & 1) = 1")
    return found.withColumn(flag, never_null(hit) & F.col(key).isNotNull()).drop("_at", "_word", "_bits")


def orphans(fact: DataFrame, users: DataFrame, key: str = "user_id", dimension_key: str = "user_id") -> DataFrame:
    """Fact rows whose non-blank key is in no dimension row.

    The missing keys come from key counts. The fact is then read once: a sieve of these keys keeps rows with other keys where
    they are, and what is left meets the keys themselves in a join that adaptive execution can split.
    """
    missing = missing_keys(fact, users, key, dimension_key)
    keyed = fact.where(~is_blank(key)).withColumn("_key", trimmed(key))
    possible = sieved(keyed, "_key", missing, "_possible").where("_possible").drop("_possible")
    return possible.join(missing, "_key", "left_semi").select(*fact.columns)


def normalised_left_join(fact: DataFrame, users: DataFrame, key: str = "user_id", dimension_key: str = "user_id") -> DataFrame:
    """Every fact row with the trimmed id of its user, NULL where there is none."""
    matched = known_keys(users, dimension_key).withColumn("matched_user_id", F.col("_key"))
    return fact.withColumn("_key", trimmed(key)).join(matched, "_key", "left").drop("_key")


def join_coverage(
    fact: DataFrame, users: DataFrame, min_ratio: float, key: str = "user_id", dimension_key: str = "user_id"
) -> DataFrame:
    """Share of fact rows with a known user, blank keys counting as unknown, against a threshold."""
    counts = fact.groupBy(F.coalesce(trimmed(key), F.lit("")).alias("_key")).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    known = known_keys(users, dimension_key).withColumn("_known", F.lit(True))
    totals = counts.join(known, "_key", "left").agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col("_known"), F.col("_rows"))), F.lit(0)).alias("matched_rows"),
    )
    ratio = F.when(F.col("total_rows") > 0, F.col("matched_rows") / F.col("total_rows")).otherwise(F.lit(0.0))
    return totals.select(
        "total_rows",
        "matched_rows",
        ratio.alias("coverage"),
        F.lit(float(min_ratio)).alias("min_ratio"),
        (ratio >= min_ratio).alias("passed"),
    )


def skewed_left_join(left: DataFrame, right: DataFrame, key: str, part_rows: int = PART_ROWS) -> DataFrame:
    """A left join whose right side may hold keys with very many rows.

    Adaptive execution splits a hot left partition but cannot split the right side of a left join. So a key with more than
    ``part_rows`` right rows is dealt into as many parts as it takes, by a hash of its rows, and the left rows of that
    key visit each part. Such a key always has right rows, hence its empty visits can be dropped and the result is that
    of the plain join. Keys are counted before the shuffle; the table of large keys is joined, not collected.
    """
    values = [name for name in right.columns if name != key]
    counts = right.where(F.col(key).isNotNull()).groupBy(*apart(key)).agg(F.count(F.lit(1)).alias("_rows"))
    large = counts.where(F.col("_rows") > part_rows).select(key, F.ceil(F.col("_rows") / part_rows).cast("int").alias("_parts"))
    dealt = right.join(large, key, "left").select(
        key,
        *values,
        F.coalesce(F.pmod(F.xxhash64(*values), F.col("_parts")).cast("int"), F.lit(0)).alias("_part"),
        F.lit(True).alias("_met"),
    )
    visits = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    visiting = left.join(large, key, "left").select(*left.columns, F.col("_parts").isNotNull().alias("_large"), F.explode(visits).alias("_part"))
    joined = visiting.join(dealt, [key, "_part"], "left")
    return joined.where(F.col("_met") | ~F.col("_large")).select(*left.columns, *values)


def unmatched(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left rows without a partner."""
    names = list(keys)
    present = right.groupBy(*names, F.xxhash64(*names).alias("_apart")).agg(F.count(F.lit(1)).alias("_rows"))
    return left.join(present.select(*names), names, "left_anti")


def never_null(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))
