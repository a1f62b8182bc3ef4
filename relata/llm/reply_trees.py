"""Chat formatting: the best root-to-leaf branches of reply trees, each written as one conversation. DataFrame functions only.

Messages point to the message they answer. Iterative self-joins double the pointers: after round k each message knows
the one 2^k steps up and the score of the way there, so a tree of depth d takes log2(d) joins of one row per message,
and neither paths nor sums are copied along. The leaves then rank as ends of branches by the score of their whole path
(longer paths and lesser ids first on ties), and the stored pointers, taken from the longest to the shortest, list the
messages of each chosen branch.

A turn is written as ``<s>role[INST]text[/INST]</s>``. In role and text ``&``, ``<`` and ``[`` are written ``&amp;``,
``&lt;`` and ``&lb;``, so no control string comes from a text and reading back gives the text itself. The loss mask is
the spans of the assistant's texts in the conversation, in code points.

Defined results: null roles and texts are empty, null scores zero; a parent that its tree lacks counts as none; of several
rows with one tree and node the least stays; messages in or below a circle have no root and are left out; a null tree
id is a tree as any other; further columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relata.llm.frames import stored

# The control strings of the template.
TURN_BEGINS, TEXT_BEGINS, TEXT_ENDS, TURN_ENDS = "<s>", "[INST]", "[/INST]", "</s>"
ASSISTANT = "assistant"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lb;"))


def escaped(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescaped(text: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def chain(rows: DataFrame, tree: str = "conv_id", order: str = "turn") -> DataFrame:
    """Flat conversations as reply trees: each row answers the one before it, in order of ``order``, role and text."""
    role, text = (F.coalesce(name, F.lit("")).alias(name) for name in ("role", "text"))
    numbered = rows.select(F.col(tree).alias("tree"), F.col(order).alias("place"), role, text)
    number = F.row_number().over(Window.partitionBy("tree").orderBy("place", "role", "text")).cast("long")
    numbered = numbered.select("tree", number.alias("node"), "role", "text")
    parent = F.when(F.col("node") > 1, F.col("node") - 1)
    return numbered.select("tree", "node", parent.alias("parent"), "role", "text", F.lit(1.0).alias("score"))


def _messages(trees: DataFrame) -> DataFrame:
    """One row for each tree and node, parents that exist, no nulls but in tree and parent."""
    columns = ("parent", "role", "text", "score")
    least = trees.where("node is not null").groupBy("tree", "node").agg(F.min(F.struct(*columns)).alias("row"))
    rows = stored(least.select("tree", "node", *[f"row.{name}" for name in columns]), "messages")
    known = rows.select(F.col("tree").alias("its"), F.col("node").alias("above"))
    rows = rows.join(known, F.col("tree").eqNullSafe(F.col("its")) & (F.col("parent") == F.col("above")), "left")
    return rows.select(
        "tree",
        "node",
        F.col("above").alias("parent"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
    )


def climb(messages: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Score and length of each message's path from its root, and for each k the message 2^k steps up, where there is one."""
    first = stored(messages.select("tree", "node", F.col("parent").alias("up"), "score", F.lit(1).cast("long").alias("steps")), "climb")
    most, levels = first.count(), []
    # Messages that have come to their root take no part in further rounds but as what others reach.
    arrived, active = [first.where("up is null")], first.where("up is not null")
    while (1 << len(levels)) < 2 * most and not active.isEmpty():
        levels.append(active.select("tree", "node", "up"))
        every = reduce(DataFrame.union, [*arrived, active])
        above = every.select(*[F.col(name).alias(f"above_{name}") for name in ("tree", "node", "up", "score", "steps")])
        meets = F.col("tree").eqNullSafe(F.col("above_tree")) & (F.col("up") == F.col("above_node"))
        moved = active.join(above, meets).select(
            "tree",
            "node",
            F.col("above_up").alias("up"),
            (F.col("score") + F.col("above_score")).alias("score"),
            (F.col("steps") + F.col("above_steps")).alias("steps"),
        )
        moved = stored(moved, "climb")
        arrived.append(moved.where("up is null"))
        active = moved.where("up is not null")
    return reduce(DataFrame.union, arrived).drop("up"), levels


def branches(trees: DataFrame, best: int = 1) -> DataFrame:
    """The messages of the ``best`` branches of each tree: tree, ``rank``, ``leaf``, ``place`` from the root, node, role, text.

    ``trees`` has tree, node, parent, role, text and score, one row per message.
    """
    messages = stored(_messages(trees), "messages")
    paths, levels = climb(messages)
    parents = messages.where("parent is not null").select(F.col("tree").alias("its"), F.col("parent").alias("above")).distinct()
    leaves = paths.join(parents, F.col("tree").eqNullSafe(F.col("its")) & (F.col("node") == F.col("above")), "left_anti")
    order = Window.partitionBy("tree").orderBy(F.desc("score"), F.desc("steps"), "node")
    chosen = leaves.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    listed = stored(chosen.select("tree", "rank", F.col("node").alias("leaf"), "node", F.col("steps").alias("place")), "branches")
    for k in reversed(range(len(levels))):
        up = levels[k].select(F.col("tree").alias("its"), F.col("node").alias("below"), "up")
        higher = listed.join(up, F.col("tree").eqNullSafe(F.col("its")) & (F.col("node") == F.col("below")))
        higher = higher.select("tree", "rank", "leaf", F.col("up").alias("node"), (F.col("place") - (1 << k)).alias("place"))
        listed = stored(listed.union(higher), "branches")
    content = messages.select(F.col("tree").alias("its"), F.col("node").alias("same"), "role", "text")
    found = listed.join(content, F.col("tree").eqNullSafe(F.col("its")) & (F.col("node") == F.col("same")))
    return found.select("tree", "rank", "leaf", "place", "node", "role", "text")


def conversations(listed: DataFrame) -> DataFrame:
    """One row per branch: tree, rank, leaf, ``formatted`` and ``loss_spans``, an array of (start, end)."""
    role, text = escaped(F.col("role")), escaped(F.col("text"))
    head = F.concat(F.lit(TURN_BEGINS), role, F.lit(TEXT_BEGINS))
    turn = F.concat(head, text, F.lit(TEXT_ENDS + TURN_ENDS))
    rows = listed.select(
        "tree", "rank", "leaf", "place", turn.alias("turn"), F.length(head).alias("skip"), F.length(text).alias("long"),
        (F.col("role") == ASSISTANT).alias("counts"),
    )
    before = Window.partitionBy("tree", "rank", "leaf").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum(F.length("turn").cast("long")).over(before), F.lit(0)) + F.col("skip")
    rows = rows.select("tree", "rank", "leaf", "place", "turn", "counts", begin.alias("start"), (begin + F.col("long")).alias("end"))
    turns = F.array_sort(F.collect_list(F.struct("place", "turn")))
    spans = F.array_sort(F.collect_list(F.when(F.col("counts"), F.struct("start", "end"))))
    rows = rows.groupBy("tree", "rank", "leaf").agg(turns.alias("turns"), spans.alias("loss_spans"))
    return rows.select("tree", "rank", "leaf", F.array_join(F.col("turns.turn"), "").alias("formatted"), "loss_spans")


def read_back(written: DataFrame, *keys: str) -> DataFrame:
    """The turns of formatted conversations: ``keys``, ``place``, role, text, and whether the loss mask covers the text."""
    pieces = F.split("formatted", TURN_ENDS)
    # What follows the last end mark is empty.
    turns = written.select(*keys, F.posexplode(F.slice(pieces, 1, F.size(pieces) - 1)).alias("place", "turn"))
    before = Window.partitionBy(*keys).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum(F.length("turn").cast("long") + len(TURN_ENDS)).over(before), F.lit(0))
    parts = F.split("turn", r"\[/?INST\]")
    role, text = F.substring(F.get(parts, F.lit(0)), len(TURN_BEGINS) + 1, 1 << 30), F.get(parts, F.lit(1))
    start = begin + len(TURN_BEGINS) + F.length(role) + len(TEXT_BEGINS)
    turns = turns.select(*keys, "place", unescaped(role).alias("role"), unescaped(text).alias("text"), start.alias("start"), (start + F.length(text)).alias("end"))
    masked = written.select(*[F.col(key).alias(f"its_{key}") for key in keys], F.explode("loss_spans").alias("span"))
    meets = (F.col("start") == F.col("span.start")) & (F.col("end") == F.col("span.end"))
    for key in keys:
        meets &= F.col(key).eqNullSafe(F.col(f"its_{key}"))
    return turns.join(masked, meets, "left").select(*keys, "place", "role", "text", F.col("span").isNotNull().alias("masked"))


def digests(written: DataFrame, *keys: str) -> DataFrame:
    """``keys``, number and SHA-256 of the turns and of the text under the loss mask, both read back, and the written length."""
    turns = read_back(written, *keys)
    turn = F.concat("role", F.lit("\n"), "text", F.lit("\n"))
    ordered = F.array_sort(F.collect_list(F.struct("place", turn.alias("turn"), F.when(F.col("masked"), F.col("text")).otherwise("").alias("loss"))))
    rows = turns.groupBy(*keys).agg(F.count("*").alias("n_turns"), ordered.alias("rows"))
    rows = rows.select(*keys, "n_turns", F.array_join("rows.turn", "").alias("turns"), F.array_join("rows.loss", "").alias("loss"))
    rows = rows.select(
        *keys, "n_turns", F.sha2("turns", 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
    )
    lengths = written.select(*[F.col(key).alias(f"its_{key}") for key in keys], F.length("formatted").cast("long").alias("formatted_chars"))
    meets = F.lit(True)
    for key in keys:
        meets = F.col(key).eqNullSafe(F.col(f"its_{key}")) & meets
    return rows.join(lengths, meets).select(*rows.columns, "formatted_chars")
