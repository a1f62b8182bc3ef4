"""Removing runs of lines that occur earlier in the corpus, by hashes of word windows. DataFrame functions only.

Lines are cut at newlines and compared without surrounding white space; blank ones do not count. A line goes if it lies
in a run of at least ``MIN_WORDS`` words that occurs earlier, anywhere, in order of id and line; blank lines inside go too.

From each line on, and up to each line, the least lines of at least ``MIN_WORDS`` words form a window; its fingerprint is
the digest of all its lines. A window that has occurred before is a repeated run. Together such windows cover each line
of every repeated run: where the run holds enough words from the line on, the window that starts there lies in it; where
it holds enough up to the line, the one that ends there does; else the one that starts with the run reaches over the
line. So one lookup, of the first place of each digest, is exact: it only asks whether there is an earlier one, and no
partner is chosen, extended or left out. No pairs of occurrences are formed. The joined tables are stored, so that
adaptive execution can split an often repeated window.

Defined results: a null text stays null and has no lines; a row with the same id and text as another is the same
document and gets the same result; rows with one id and different texts are ordered by a hash of the text; null ids
come last; further columns stay (a column ``n_chars`` is set to the new length where the text changes); an empty table
gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relata.llm.frames import stored

#: Words a repeated run has at least.
MIN_WORDS = 50

SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"
OWNER = ["late", "number", "text_key"]


def _owned(docs: DataFrame, key: str, text: str, *rest: Column) -> DataFrame:
    """``rest`` beside the columns that order documents and tell them apart, none of them null."""
    number = F.coalesce(F.col(key), F.lit(0).cast(docs.schema[key].dataType))
    return docs.select(*rest, F.col(key).isNull().alias("late"), number.alias("number"), F.xxhash64(text).alias("text_key"))


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once even where ``body`` uses it for each element of an array."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _pieces(text: Column) -> Column:
    return F.split(text, "\n", -1)


def lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's lines with words: owner, index among such lines ``at``, ``hash``, ``words``, words ``before``."""
    cut = _owned(docs, key, text, F.col(text).alias("text")).select(*OWNER, F.posexplode(_pieces(F.col("text"))).alias("place", "line"))
    cut = cut.withColumn("line", F.btrim("line", F.lit(SPACE))).where("line != ''")
    cut = cut.select(*OWNER, "place", F.xxhash64("line").alias("hash"), F.size(F.split("line", SPACES)).cast("long").alias("words"))
    cut = cut.repartition(*OWNER).dropDuplicates([*OWNER, "place"])
    order = Window.partitionBy(*OWNER).orderBy("place")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    return cut.select(
        *OWNER,
        F.row_number().over(order).alias("at"),
        "hash",
        "words",
        F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before"),
    )


def windows(found: DataFrame) -> DataFrame:
    """The windows of ``lines``: from ``at`` to ``end``, and the ``digest`` of their lines."""
    owner = Window.partitionBy(*OWNER)
    onward = owner.orderBy("before").rangeBetween(0, MIN_WORDS - 1)
    upward = owner.orderBy("after").rangeBetween(-(MIN_WORDS - 1), 0)

    def window(frame) -> Column:
        ends = F.first("at").over(frame).alias("at"), F.last("at").over(frame).alias("end")
        return F.struct(*ends, F.xxhash64(F.collect_list("hash").over(frame)).alias("digest"), F.sum("words").over(frame).alias("size"))

    both = found.withColumn("after", F.col("before") + F.col("words"))
    both = both.select(*OWNER, "words", window(onward).alias("onward"), window(upward).alias("upward"))
    # A window that also starts with its first line needs no row for its end.
    ends_only = F.when(F.col("upward.size") - F.col("words") >= MIN_WORDS, F.col("upward"))
    both = both.select(*OWNER, F.explode(F.array("onward", ends_only)).alias("window"))
    return both.where(F.col("window.size") >= MIN_WORDS).select(*OWNER, "window.at", "window.end", "window.digest")


def matches(held: DataFrame) -> DataFrame:
    """The windows that occur earlier: owner and the line range ``low`` to ``high``."""
    held = stored(held, "windows")
    place = F.struct(*OWNER, "at")
    first = held.groupBy("digest").agg(F.count("*").alias("times"), F.min(place).alias("first"))
    first = stored(first.where("times > 1").select("digest", "first"), "first-windows")
    later = held.join(first, "digest").where(place > F.col("first"))
    return later.select(*OWNER, F.col("at").alias("low"), F.col("end").alias("high"))


def repeated_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``runs`` of each owner that has any: its merged line ranges to remove, as an array of (low, high)."""
    found = matches(windows(lines(docs, key, text)))
    order = Window.partitionBy(*OWNER).orderBy("low", "high")
    reach = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce(F.col("low") > reach + 1, F.lit(True)).cast("long")
    merged = found.select(*OWNER, "low", "high", begins.alias("begins"))
    merged = merged.withColumn("run", F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = merged.groupBy(*OWNER, "run").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    return merged.groupBy(*OWNER).agg(F.collect_list(F.struct("low", "high")).alias("runs"))


def _numbered(pieces: Column) -> Column:
    """Where the lines with words stand among all pieces of a text."""
    return F.filter(F.transform(pieces, lambda piece, i: F.when(F.btrim(piece, F.lit(SPACE)) != "", i)), lambda i: i.isNotNull())


def _rest(pieces: Column, runs: Column) -> Column:
    """The pieces outside of ``runs``, which count lines with words only."""

    def ranges(full: Column) -> Column:
        at = lambda place: F.get(full, place.cast("int") - 1)
        return F.transform(runs, lambda run: F.struct(at(run["low"]).alias("low"), at(run["high"]).alias("high")))

    def outside(gone: Column) -> Column:
        return F.filter(pieces, lambda piece, i: ~F.exists(gone, lambda run: i.between(run["low"], run["high"])))

    return _let(_let(_numbered(pieces), ranges), outside)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with later repeated runs removed from ``text``; adds ``n_lines`` and ``n_removed`` (lines with words)."""
    runs = stored(repeated_runs(docs, key, text), "runs")
    # The row is wrapped, so that its columns may have any names.
    owned = _owned(docs, key, text, F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"))
    # A merge join at any size, so that cost grows with the input and no table of runs is broadcast.
    joined = owned.join(runs.hint("merge"), [owned[name] == runs[name] for name in OWNER], "left").select("row", "runs")
    old = F.col(f"row.`{text}`")
    joined = joined.select(
        "row",
        F.when(F.col("runs").isNull(), old).otherwise(F.array_join(_let(_pieces(old), lambda pieces: _rest(pieces, F.col("runs"))), "\n")).alias("new"),
        F.coalesce(F.size(_numbered(_pieces(old))).cast("long"), F.lit(0)).alias("n_lines"),
        F.coalesce(F.aggregate("runs", F.lit(0).cast("long"), lambda total, run: total + run["high"] - run["low"] + 1), F.lit(0)).alias("n_removed"),
    )
    values = []
    for name in docs.columns:
        value = F.col(f"row.`{name}`")
        if name == text:
            value = F.col("new")
        elif name == "n_chars":
            value = F.when(F.col("n_removed") > 0, F.length("new").cast(docs.schema[name].dataType)).otherwise(value)
        if name not in ("n_lines", "n_removed"):
            values.append(value.alias(name))
    return joined.select(*values, "n_lines", "n_removed")
