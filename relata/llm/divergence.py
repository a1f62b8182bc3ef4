"""How the sources of a language differ in the terms they use: exact pairwise distances, and each source's typical terms.

Terms are runs of ASCII letters and characters beyond ASCII, A-Z lower-cased. A language keeps the terms that are in
enough of its documents. A group (a source of a language) gives a kept term with ``count`` occurrences the rate
``p = 1 + SCALE * (count + SMOOTH) div (total + SMOOTH * terms)``; ``zero`` is the rate of an absent term.

The distance of two groups is the sum of |p - q| over all kept terms. Were all terms absent, it would be
``terms * |zero_a - zero_b|``. What a present term changes is a correction of one group alone, summed from the histogram of
that group's rates, and, where both groups have the term, one of the pair. For these a frequent-pattern tree is built: a
term's row is its list of (source, rate) with nonzero counts, ordered by source; equal rows are one with a multiplicity, and
rows with a common start share a path. Each pair of a node and an ancestor is corrected once, times the node's
multiplicity. Rows are sorted over range partitions, so that common starts lie in one task; each batch of rows has a tree
of its own, and the trees' corrections add up. All arithmetic is on integers.

Sizes: a row is as long as its language has sources, and all pairs of the sources of a language are part of the result.
Nothing else grows faster than the number of distinct (language, source, term). Occurrences are counted before the shuffle,
so that frequent terms and large sources are rows like others.

Defined results: null texts, languages and sources are empty strings; rows with equal or null ids are each a document;
a group without terms has every kept term zero times; without kept terms all distances are 0; ties are ordered by the
item's UTF-8 bytes; further columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relata.llm.frames import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates terms.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS = 30
SCALE = 1_000_000_000
SMOOTH = 5
TOP = 50
#: Items of the rows that one tree is built from, but for a single longer row.
TREE_ITEMS = 1 << 20

SHARED = pa.schema([("lang", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("value", pa.int64())])


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``term``, its occurrences ``n`` and the ``docs`` that hold it, of columns lang, source, text."""
    words = F.split(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), BETWEEN)
    words = docs.select(*[F.coalesce(name, F.lit("")).alias(name) for name in ("lang", "source")], F.sort_array(words).alias("words"))
    # In a sorted list a document's first occurrence of a term is one that differs from the word before.
    fresh = F.transform("words", lambda word, i: F.struct(word.alias("term"), ((i == 0) | (F.get("words", i - 1) != word)).cast("int").alias("fresh")))
    found = words.select("lang", "source", F.explode(fresh).alias("w")).select("lang", "source", "w.term", "w.fresh").where("term != ''")
    return found.groupBy("lang", "source", "term").agg(F.count("*").alias("n"), F.sum("fresh").alias("docs"))


def rate(count: str, total: str, terms: str, scale: int, smooth: int) -> Column:
    """The exact rate of a term from the names of three columns; 0 in a language without terms."""
    above = f"(cast({count} as decimal(20,0)) + {smooth}) * {scale}"
    below = f"(cast({total} as decimal(20,0)) + {smooth} * {terms})"
    return F.expr(f"case when {terms} > 0 then cast(1 + {above} div {below} as bigint) else bigint(0) end")


def _trie(rows: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """The tree of sorted rows (lang, path, held): for each node its parent (-1: none), first row, place in the path, multiplicity."""
    path = rows.column(1)
    marks = path.offsets.to_numpy().astype(np.int64)
    sizes, base = np.diff(marks), marks[0]
    held = rows.column(2).to_numpy()
    items = path.values
    numbers, rates = items.field(0).to_numpy(), items.field(1).to_numpy()
    langs = rows.column(0).dictionary_encode().indices.to_numpy()
    # Does a row share all items so far with the row before?
    same = np.concatenate([[False], langs[1:] == langs[:-1]])
    above = np.full(rows.num_rows, -1)
    parents, firsts, depths, weights, made = [], [], [], [], 0
    for depth in range(int(sizes.max(initial=0))):
        inside = np.flatnonzero(sizes > depth)
        at = marks[inside] + depth
        before = inside - 1
        near = same[inside] & (sizes[before] > depth)
        earlier = np.where(near, marks[before] + depth, base)
        near &= (numbers[earlier] == numbers[at]) & (rates[earlier] == rates[at])
        fresh = np.flatnonzero(~near)
        parents.append(above[inside[fresh]])
        firsts.append(inside[fresh])
        depths.append(np.full(len(fresh), depth))
        weights.append(np.add.reduceat(held[inside], fresh))
        above[inside] = made + np.cumsum(~near) - 1
        same[inside] = near
        made += len(fresh)
    if not made:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(x) for x in (parents, firsts, depths, weights))


def pair_corrections(rows: pa.RecordBatch) -> pa.RecordBatch:
    """What the terms of sorted rows (lang, path of (number, rate, zero), held) add to the distances of pairs that share them."""
    parents, firsts, depths, weights = _trie(rows)
    items, marks = rows.column(1).values, rows.column(1).offsets.to_numpy().astype(np.int64)
    at = marks[firsts] + depths
    numbers, rates, zeros = (items.field(i).to_numpy()[at] for i in range(3))
    encoded = rows.column(0).dictionary_encode()
    langs = encoded.indices.to_numpy()[firsts].astype(np.int64)
    width = int(numbers.max(initial=0)) + 1
    keys, sums = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    nodes, above = np.arange(len(parents)), parents
    while True:
        # The next ancestor of all nodes that have one.
        nodes, above = nodes[above >= 0], above[above >= 0]
        if not len(nodes):
            break
        p, q, x, y = rates[above], rates[nodes], zeros[above], zeros[nodes]
        change = weights[nodes] * (np.abs(p - q) - np.abs(p - y) - np.abs(x - q) + np.abs(x - y))
        found, place = np.unique((langs[nodes] * width + numbers[above]) * width + numbers[nodes], return_inverse=True)
        total = np.zeros(len(found), np.int64)
        np.add.at(total, place, change)
        keys.append(found)
        sums.append(total)
        above = parents[above]
    found, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(found), np.int64)
    np.add.at(total, place, np.concatenate(sums))
    columns = [
        encoded.dictionary.take(pa.array(found // (width * width))),
        pa.array((found // width % width).astype(np.int32)),
        pa.array((found % width).astype(np.int32)),
        pa.array(total),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=SHARED)


def _corrections(batches):
    for batch in batches:
        low = 0
        while low < batch.num_rows:
            marks = batch.column(1).offsets.to_numpy()
            high = max(low + 1, int(np.searchsorted(marks, marks[low] + TREE_ITEMS, side="right")) - 1)
            yield pair_corrections(batch.slice(low, high - low))
            low = high


def shared_terms(rates: DataFrame) -> DataFrame:
    """The summed corrections ``value`` of each pair ``a`` < ``b`` of group numbers that share terms, from rates of all groups."""
    path = F.sort_array(F.collect_list(F.struct("number", "p", "zero"))).alias("path")
    rows = rates.groupBy("lang", "term").agg(path).groupBy("lang", "path").agg(F.count("*").alias("held"))
    rows = stored(rows.where(F.size("path") > 1), "term-rows")
    rows = rows.repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")
    found = rows.mapInArrow(_corrections, "lang string, a int, b int, value long")
    return found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def own_terms(rates: DataFrame, pairs: DataFrame) -> DataFrame:
    """The corrections ``value`` that the terms of group ``a`` alone make to its distance from ``b``."""
    counts = rates.groupBy("lang", F.col("number").alias("a"), "p").agg(F.count("*").alias("held"))
    none = F.lit(None)
    points = counts.select("lang", "a", "p", "held", none.cast("int").alias("b"), none.cast("long").alias("zero"))
    asked = pairs.select("lang", "a", F.col("zero_b").alias("p"), F.lit(0).cast("long").alias("held"), "b", F.col("zero_a").alias("zero"))
    # Terms with a rate up to the other's zero, and all of the group.
    upto = Window.partitionBy("lang", "a").orderBy("p").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("lang", "a")
    terms, rated = F.col("held"), F.col("held") * F.col("p")
    found = points.union(asked).select(
        "lang", "a", "b", "p", "zero", F.sum(terms).over(upto).alias("n"), F.sum(rated).over(upto).alias("s"),
        F.sum(terms).over(whole).alias("n_all"), F.sum(rated).over(whole).alias("s_all"),
    )
    value = F.expr("n * p - s + (s_all - s) - (n_all - n) * p - n_all * abs(zero - p)")
    return found.where("b is not null").select("lang", "a", "b", value.alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, scale: int = SCALE, smooth: int = SMOOTH, top: int = TOP) -> DataFrame:
    """The report on ``docs`` (lang, source, text): ``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``.

    Part ``pair`` has the distance to each other source of the language, largest first; part ``term`` the ``top`` terms
    whose rate in the source is most above that in the language.
    """
    counts = term_counts(docs)
    entries = F.collect_list(F.struct("source", "n")).alias("entries")
    terms = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n_lang"), entries)
    terms = stored(terms.where(F.col("docs") >= min_docs).drop("docs"), "kept-terms")
    single = stored(terms.select("lang", "term", "n_lang", F.explode("entries").alias("e")).select("lang", "term", "n_lang", "e.source", "e.n"), "kept-counts")

    kept = terms.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n_lang").alias("lang_total"))
    totals = single.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select(*[F.coalesce(name, F.lit("")).alias(name) for name in ("lang", "source")]).distinct()
    groups = groups.join(totals, ["lang", "source"], "left").join(kept, "lang", "left").na.fill(0, ["total", "terms", "lang_total"])
    groups = groups.withColumn("number", F.row_number().over(Window.partitionBy("lang").orderBy("source")))
    groups = groups.withColumn("none", F.lit(0)).withColumn("zero", rate("none", "total", "terms", scale, smooth)).drop("none")
    groups = stored(groups, "groups")

    rates = single.join(groups, ["lang", "source"])
    p, q = rate("n", "total", "terms", scale, smooth), rate("n_lang", "lang_total", "terms", scale, smooth)
    rates = stored(rates.select("lang", "source", "term", "number", "zero", p.alias("p"), q.alias("q")), "rates")

    places = groups.select("lang", F.col("number").alias("a"), F.col("zero").alias("zero_a"), F.col("terms").alias("n_terms"))
    others = groups.select("lang", F.col("number").alias("b"), F.col("zero").alias("zero_b"))
    pairs = stored(places.join(others, "lang").where("a != b"), "pairs")
    base = pairs.where("a < b").select("lang", "a", "b", F.expr("n_terms * abs(zero_a - zero_b)").alias("value"))
    own = own_terms(rates, pairs).select("lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "value")
    distances = base.union(own).union(shared_terms(rates)).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("pair")
    distances = distances.select("lang", both, "value").select("lang", "pair.a", "pair.b", "value")
    left = groups.select("lang", F.col("number").alias("a"), "source")
    right = groups.select("lang", F.col("number").alias("b"), F.col("source").alias("item"))
    distances = distances.join(left, ["lang", "a"]).join(right, ["lang", "b"]).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    distances = distances.withColumn("rank", F.row_number().over(order))
    typical = rates.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    typical = typical.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return distances.union(typical)
