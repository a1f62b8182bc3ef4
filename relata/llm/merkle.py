"""A Merkle manifest of a dataset: one digest over all rows, with a proof of each row and a check against a changed copy.

A leaf is the SHA-256 of a row's fields. The leaves of a group (say, a source) ascend by key; every three neighbours (the
last run may be shorter) become the digest of their concatenation until one is left, the group's subroot. Subroots,
ordered by group, are reduced alike to the root. A proof holds, level by level, what stands left and right of a row's path.

Rows are numbered within their group by a range-partitioned sort and counted partitions. A *superblock* is a run of
3^LEVELS neighbouring nodes. On the way up each superblock is reduced to one node, then the superblocks of these nodes,
until a tree has one node. On the way down the nodes of a superblock are cogrouped with the one outer path that all of
them need; there ``applyInPandas`` finishes the local reduction, joins the proofs and, for leaves, folds the checked
digests up to the root. No task holds more than a superblock, so a group may hold any share of the rows.

Defined results: null fields are written ``-``; a null group is a group of its own and comes first; null keys come first
in their group, equal keys are ordered by their leaves; further columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relata.llm.frames import stored

FAN = 3
#: Levels that one superblock reduces: at most 2,187 nodes.
LEVELS = 7
#: The fields of a leaf in their order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

NODE = "tree long, place long, width long, digest string"
PATH = "tree long, place long, lefts array<string>, rights array<string>, subroot string, root string"
PROOF = (
    "tree long, place long, key string, leaf string, lefts array<string>, rights array<string>, subroot string, root string, "
    "folded_root string, verified boolean"
)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(*fields: Column) -> Column:
    """The digest of a row's fields: each its UTF-8 byte count, a colon and its value, or ``-``."""
    written = []
    for field in fields:
        value = field.cast("string")
        written.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*written), 256)


def runs_of(count: int) -> int:
    return -(-count // FAN)


def reduce(nodes: list[str], width: int, most: int) -> list[list[str]]:
    """The levels above neighbouring ``nodes`` of a tree that is ``width`` nodes wide, at most ``most`` of them."""
    levels = [nodes]
    while width > 1 and len(levels) <= most:
        below = levels[-1]
        levels.append([digest("".join(below[i : i + FAN])) for i in range(0, len(below), FAN)])
        width = runs_of(width)
    return levels


def beside(levels: list[list[str]]) -> tuple[list[list[str]], list[list[str]]]:
    """For each node of the lowest level, what stands left and right of its path at each level but the top one."""
    lefts, rights = [], []
    for place in range(len(levels[0])):
        left, right = [], []
        for level in levels[:-1]:
            first = place - place % FAN
            left.append("".join(level[first:place]))
            right.append("".join(level[place + 1 : first + FAN]))
            place //= FAN
        lefts.append(left)
        rights.append(right)
    return lefts, rights


def fold(start: str, lefts: list[str], rights: list[str]) -> str:
    """The root that ``start`` leads to by a proof."""
    for left, right in zip(lefts, rights, strict=True):
        start = digest(left + start + right)
    return start


def _block(levels: int) -> Column:
    place = F.col("place")
    return ((place - F.pmod(place, F.lit(FAN**levels))) / F.lit(FAN**levels)).cast("long").alias("block")


def numbered(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaves (``group``, ``order``, ``leaf``, ``check``) as nodes with ``tree``, ``place`` and ``width``; and the trees' groups.

    Trees are numbered in the order of their groups.
    """
    leaves = stored(leaves, "leaves")
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ordered = leaves.repartitionByRange("group", "order", "leaf").sortWithinPartitions("group", "order", "leaf")
    ordered = stored(ordered.select("*", F.spark_partition_id().alias("part"), at.alias("at")), "ordered")
    runs = stored(ordered.groupBy("part", "group").agg(F.count("*").alias("held"), F.min("at").alias("first")), "runs")
    # A group starts in one partition: its number is that of the groups that start before.
    starts = F.min(F.struct("part", "first"))
    groups = runs.groupBy("group").agg(F.sum("held").alias("width"), starts.alias("start"))
    groups = groups.select("group", "width", F.col("start.part").alias("part"), F.col("start.first").alias("first"))
    within = F.row_number().over(Window.partitionBy("part").orderBy("first"))
    groups = stored(groups.withColumn("within", within), "groups")
    # One row per shuffle partition.
    earlier = F.sum("held").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = groups.groupBy("part").agg(F.count("*").alias("held")).select("part", F.coalesce(earlier, F.lit(0)).alias("before"))
    groups = groups.join(parts, "part").select("group", "width", (F.col("before") + F.col("within") - 1).alias("tree"))
    groups = stored(groups, "trees")
    earlier = F.sum("held").over(Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("part", "group", (F.coalesce(earlier, F.lit(0)) - F.col("first")).alias("shift")).alias("r")
    same = F.col("r.group").eqNullSafe(F.col("g.group"))
    runs = runs.join(groups.alias("g"), same).select("r.part", F.col("r.group").alias("run_group"), "r.shift", "g.tree", "g.width")
    runs = stored(runs, "placed-runs")
    same = (F.col("o.part") == F.col("r.part")) & F.col("o.group").eqNullSafe(F.col("r.run_group"))
    nodes = ordered.alias("o").join(runs.alias("r"), same)
    nodes = nodes.select("r.tree", (F.col("o.at") + F.col("r.shift")).alias("place"), "r.width", "o.key", F.col("o.leaf").alias("digest"), "o.check")
    return stored(nodes, "nodes"), groups


def _reduced(nodes: pd.DataFrame, levels: int) -> pd.DataFrame:
    """One node for a superblock."""
    nodes = nodes.sort_values("place")
    width = int(nodes["width"].iat[0])
    block = int(nodes["place"].iat[0]) // FAN**levels
    top = reduce(nodes["digest"].tolist(), width, levels)[-1][0]
    return pd.DataFrame({"tree": [int(nodes["tree"].iat[0])], "place": [block], "width": [-(-width // FAN**levels)], "digest": [top]})


def climb(nodes: DataFrame, levels: int = LEVELS) -> list[DataFrame]:
    """Rounds of nodes: each round has one node for a superblock of the round before; trees with one node go no further."""
    rounds = []
    while not rounds or not rounds[-1].where("width > 1").isEmpty():
        below = rounds[-1].where("width > 1") if rounds else nodes
        grouped = below.select("tree", "place", "width", "digest", _block(levels)).groupBy("tree", "block")
        found = grouped.applyInPandas(lambda nodes: _reduced(nodes, levels), NODE)
        rounds.append(stored(found, "superblocks"))
    return rounds


def _parts(nodes: pd.DataFrame, outer: pd.DataFrame, levels: int):
    """The nodes of a superblock in order, their whole proofs, and the outer path's row."""
    nodes = nodes.sort_values("place")
    path = outer.iloc[0]
    lefts, rights = beside(reduce(nodes["digest"].tolist(), int(nodes["width"].iat[0]), levels))
    over_left, over_right = list(path["lefts"]), list(path["rights"])
    return nodes, [own + over_left for own in lefts], [own + over_right for own in rights], path


def _paths(nodes: pd.DataFrame, outer: pd.DataFrame, levels: int) -> pd.DataFrame:
    nodes, lefts, rights, path = _parts(nodes, outer, levels)
    return pd.DataFrame(
        {"tree": nodes["tree"], "place": nodes["place"], "lefts": lefts, "rights": rights, "subroot": path["subroot"], "root": path["root"]}
    )


def _proofs(nodes: pd.DataFrame, outer: pd.DataFrame, levels: int) -> pd.DataFrame:
    nodes, lefts, rights, path = _parts(nodes, outer, levels)
    root = path["root"]
    folded = [fold(*row) for row in zip(nodes["check"], lefts, rights, strict=True)]
    return pd.DataFrame(
        {
            "tree": nodes["tree"],
            "place": nodes["place"],
            "key": nodes["key"],
            "leaf": nodes["digest"],
            "lefts": lefts,
            "rights": rights,
            "subroot": path["subroot"],
            "root": root,
            "folded_root": folded,
            "verified": [found == root for found in folded],
        }
    )


def _exchanged(nodes: DataFrame, outer: DataFrame, work, schema: str, levels: int) -> DataFrame:
    """Nodes and the outer path of their superblock, brought together by superblock."""
    names = [part.split()[0] for part in schema.split(", ")]

    def found(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        # The only node of a one-node tree has a path and nothing below.
        return work(left, right, levels) if len(left) else pd.DataFrame({name: pd.Series([], dtype=object) for name in names})

    left = nodes.withColumn("block", _block(levels)).groupBy("tree", "block")
    right = outer.withColumnRenamed("place", "block").groupBy("tree", "block")
    return left.cogroup(right).applyInPandas(found, schema)


def descend(rounds: list[DataFrame], outer: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The paths of the first round's nodes. ``outer``: the path of each tree's last node."""
    paths = None
    for nodes in reversed(rounds):
        tops = nodes.where("width = 1").select("tree", "place", F.col("digest").alias("own"))
        tops = tops.join(outer, "tree").select("tree", "place", "lefts", "rights", F.coalesce("subroot", "own").alias("subroot"), "root")
        if paths is not None:
            tops = tops.union(_exchanged(nodes.where("width > 1"), paths, _paths, PATH, levels))
        paths = stored(tops, "paths")
    return paths


def manifest(
    docs: DataFrame,
    checked: Column | None = None,
    fields: tuple[str, ...] = FIELDS,
    key: str = "doc_id",
    group: str = "source",
    levels: int = LEVELS,
) -> DataFrame:
    """The proof of each row of ``docs``.

    Returns ``key``, ``leaf``, ``lefts`` and ``rights`` (the digests left and right of the path, from the leaf's level to
    that below the root), ``subroot`` of its group, ``root``, ``folded_root`` and ``verified``. The folded root comes from the
    proof and ``checked``, the leaf of the copy to verify (by default the row's own). A superblock reduces ``levels`` levels.
    """
    kind = docs.schema[key].dataType
    own = leaf(*[F.col(name) for name in fields])
    checked = own if checked is None else F.coalesce(checked, own)
    written = [F.col(group).alias("group"), F.col(key).alias("order"), F.col(key).cast("string").alias("key")]
    nodes, groups = numbered(docs.select(*written, own.alias("leaf"), checked.alias("check")))
    trees = climb(nodes.select("tree", "place", "width", "digest"), levels)
    # The subroots of all rounds are the nodes of the upper tree.
    subroots = trees[0].where("width = 1")
    for nodes_above in trees[1:]:
        subroots = subroots.union(nodes_above.where("width = 1"))
    count = groups.agg(F.count("*")).first()[0]
    zero, width = F.lit(0).cast("long").alias("tree"), F.lit(count).cast("long").alias("width")
    upper = stored(subroots.select(zero, F.col("tree").alias("place"), width, "digest"), "subroots")
    above = climb(upper, levels)
    none = F.array().cast("array<string>")
    root = above[-1].where("width = 1")
    root = root.select("tree", none.alias("lefts"), none.alias("rights"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    tops = descend([upper, *above], stored(root, "root"), levels)
    outer = tops.select(F.col("place").alias("tree"), "lefts", "rights", F.lit(None).cast("string").alias("subroot"), "root")
    proofs = _exchanged(nodes, descend(trees, outer, levels), _proofs, PROOF, levels)
    return proofs.select(F.col("key").cast(kind).alias(key), "leaf", "lefts", "rights", "subroot", "root", "folded_root", "verified")


def proof_digest() -> Column:
    """The digest of a proof's siblings from the leaf's level upwards, left to right."""
    return F.sha2(F.array_join(F.zip_with("lefts", "rights", lambda left, right: F.concat(left, right)), ""), 256)
