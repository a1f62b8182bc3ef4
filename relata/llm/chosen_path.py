"""Near-duplicate documents by a chosen-path set similarity join over MinHash tokens.

A document's set holds its distinct runs of five words (A-Z lower-cased; with fewer words the whole sequence). Documents
are linked if their sets' Jaccard similarity is at least 0.85; components of links are groups of near copies.

Equal sets are one *unit*. A unit has minwise tokens (the least value of its set under a random function each) and a
sketch of 128 further minwise values, one byte each. Independent trees branch the units: a root branches by ``BRANCHES``
of its tokens, and a unit goes to the child of each of its values. Nodes of at most ``NODE`` units are compared
exhaustively by their sketches, pair of blocks by pair of blocks. In a larger one all units are first compared with one of them, the pivot, and those close to
it leave the node, as near copies of one text stay together however often they branch; the others branch again by sketch
values chosen from the node's own hash. A node that is still large after ``DEPTH`` branchings is compared exhaustively as
well, so nothing is cut off.

Leaving costs no link: sketches that differ in d places make a metric, so whatever is alike to a unit that differs from the
pivot in at most ``CLOSE`` places differs from the pivot in at most ``CLOSE + SKETCH - AGREE``, and all such units are joined
with the pivot as candidates.

Recall: a pair at the threshold keeps a token with probability 0.85, so it meets nowhere with 0.15^8, about 3e-7, and its
sketches agree in fewer than ``AGREE`` places with 2e-8. What meets and agrees is only a candidate: candidates' components
are *families*, each unit's text is sent to its family once for each block pair, and links are confirmed there on the full
sets. Nodes and families give spanning forests found by breadth-first search, never their pairs.

Defined results: null and empty texts and such without words have an empty set and are groups of their own; rows with one
id or with null ids are each a document, a group with null ids only has a null component and its rows are kept; further
columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relata.llm.components import components
from relata.llm.frames import map_texts, offsets_of, pieces, stored
from relata.llm.hashing import VISIBLE, mix, shingle_hashes, text_bounds, word_hashes, word_places

SHINGLE = 5
#: Links need 100 * shared >= PERCENT * union.
PERCENT = 85
TREES, BRANCHES, DEPTH = 4, 2, 4
#: Units of a node that are compared exhaustively; a larger node branches.
NODE = 8192
#: Units of a block, about: what is compared in one piece are two blocks.
BLOCK = 512
SKETCH = 128
#: Places in which the sketches of a candidate agree.
AGREE = 84
#: Places in which a unit that leaves with a pivot differs from it, at most.
CLOSE = 28
#: Shingles of the units that a block of a family holds, about: 8 bytes each in a task.
BLOCK_SHINGLES = 1 << 20

_random = np.random.default_rng(85)
TOKEN_XOR, TOKEN_STEP = (_random.integers(1, 1 << 63, TREES * BRANCHES, dtype=np.uint64) for _ in range(2))
SKETCH_XOR, SKETCH_STEP = (_random.integers(1, 1 << 32, SKETCH, dtype=np.uint32) for _ in range(2))


def sets_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, ascending, one text after the other, and where each text's begin and end."""
    data, marks = offsets_of(texts)
    starts, ends = word_places(data, marks, VISIBLE)
    words = word_hashes(data, starts, ends, VISIBLE)
    bounds = text_bounds(starts, marks)
    counts = np.diff(bounds)
    hashes = shingle_hashes(words, SHINGLE)
    owner = np.repeat(np.arange(len(counts)), counts)
    inside = owner[: len(hashes)] == owner[SHINGLE - 1 :] if len(hashes) else np.zeros(0, bool)
    hashes, owner = hashes[inside], owner[: len(hashes)][inside]
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(short):
        # A whole sequence never equals a run of five.
        whole = [mix(shingle_hashes(words[a : a + n], int(n)) + np.uint64(n))[0] for a, n in zip(bounds[short], counts[short], strict=True)]
        hashes, owner = np.concatenate([hashes, np.array(whole, np.uint64)]), np.concatenate([owner, short])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    if len(hashes):
        fresh = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])])
        hashes, owner = hashes[fresh], owner[fresh]
    return hashes, np.searchsorted(owner, np.arange(len(counts) + 1))


def _described(piece: pa.RecordBatch) -> list:
    """Ids, set sizes, two digests of each set, its tokens and its sketch."""
    hashes, bounds = sets_of(piece.column(2))
    sizes = np.diff(bounds)
    some = np.flatnonzero(sizes)
    first = bounds[:-1][some]
    digests = np.zeros((2, len(sizes)), np.uint64)
    tokens = np.zeros((len(sizes), len(TOKEN_XOR)), np.uint64)
    sketch = np.zeros((len(sizes), SKETCH), np.uint8)
    if len(some):
        for place in range(2):
            digests[place, some] = mix(np.add.reduceat(mix(hashes + np.uint64(place)), first))
        for place, (turn, step) in enumerate(zip(TOKEN_XOR, TOKEN_STEP, strict=True)):
            tokens[some, place] = np.minimum.reduceat((hashes ^ turn) * (step | np.uint64(1)), first)
        short = (hashes >> np.uint64(32)).astype(np.uint32)
        for place, (turn, step) in enumerate(zip(SKETCH_XOR, SKETCH_STEP, strict=True)):
            least = np.minimum.reduceat((short ^ turn) * (step | np.uint32(1)), first)
            sketch[some, place] = (least * np.uint32(0x9E3779B1)) >> np.uint32(24)
    parts = np.arange(0, tokens.size + 1, tokens.shape[1], dtype=np.int32)
    return [
        piece.column(0),
        piece.column(1),
        pa.array(sizes.astype(np.int64)),
        *[pa.array(values.view(np.int64)) for values in digests],
        pa.ListArray.from_arrays(pa.array(parts), pa.array(tokens.reshape(-1).view(np.int64))),
        pa.FixedSizeBinaryArray.from_buffers(pa.binary(SKETCH), len(sizes), [None, pa.py_buffer(sketch.tobytes())]),
    ]


def described(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, ``text_key``, and of each row's set the size ``n``, digests ``d1`` and ``d2``, ``tokens`` and ``sketch``."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text"))
    schema = f"key {kind}, text_key long, n long, d1 long, d2 long, tokens array<long>, sketch binary"
    return map_texts(rows, ["key", "text_key", "text"], schema, _described)


def search(count: int, near: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Edges of a spanning forest of ``count`` members by breadth-first search. ``near`` says which of some members one is linked to."""
    left, edges, pending = np.arange(1, count), [], [0]
    while len(left):
        if not pending:
            pending.append(int(left[0]))
            left = left[1:]
            continue
        member = pending.pop()
        linked = near(member, left)
        if linked.any():
            found = left[linked].tolist()
            edges += [(member, other) for other in found]
            pending += found
            left = left[~linked]
    return edges


def alike(sketches: np.ndarray, sizes: np.ndarray, sketch: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    """Which sets may be similar enough to one, by their sizes and sketches."""
    ratio = np.minimum(sizes, size) * 100 >= np.maximum(sizes, size) * PERCENT
    return ratio & ((sketches == sketch).sum(axis=1) >= AGREE)


def _edges(pairs: list[tuple[int, int]], units: np.ndarray) -> pa.RecordBatch:
    ends = np.array(pairs, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(units[ends[:, 0]]), pa.array(units[ends[:, 1]])], names=["a", "b"])


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges within each run of equal (node, pair) of sorted batches; a run may go on in the next batch."""
    groups, units, sizes = np.zeros((2, 0), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    sketches = np.zeros((0, SKETCH), np.uint8)

    def found(complete: bool) -> tuple[pa.RecordBatch, int]:
        change = np.flatnonzero(np.any(groups[:, 1:] != groups[:, :-1], axis=0)) + 1
        bounds = np.concatenate([[0], change, [len(units)]])
        starts, ends = (bounds[:-1], bounds[1:]) if complete else (bounds[:-2], bounds[1:-1])
        two = starts[ends - starts == 2]
        two = two[alike(sketches[two], sizes[two], sketches[two + 1], sizes[two + 1])] if len(two) else two
        pairs = [(int(at), int(at) + 1) for at in two]
        for start, end in zip(starts, ends, strict=True):
            if end - start > 2:
                own, held = sketches[start:end], sizes[start:end]
                edges = search(int(end - start), lambda i, left, own=own, held=held: alike(own[left], held[left], own[i], held[i]))
                pairs += [(a + int(start), b + int(start)) for a, b in edges]
        return _edges(pairs, units), int(ends[-1]) if len(ends) else 0

    for batch in batches:
        if not batch.num_rows:
            continue
        groups = np.concatenate([groups, np.stack([batch.column(i).to_numpy() for i in range(2)])], axis=1)
        units = np.concatenate([units, batch.column(2).to_numpy()])
        sizes = np.concatenate([sizes, batch.column(3).to_numpy()])
        rows = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint8).reshape(-1, SKETCH)
        sketches = np.concatenate([sketches, rows])
        edges, done = found(False)
        groups, units, sizes, sketches = groups[:, done:], units[done:], sizes[done:], sketches[done:]
        yield edges
    if len(units):
        yield found(True)[0]


def _dealt(members: DataFrame, group: str, unit: str, blocks: Column) -> DataFrame:
    """``members`` once for each pair of blocks of their group, numbered by ``pair``."""
    members = members.withColumn("blocks", blocks.cast("long")).withColumn("own", F.pmod(F.xxhash64(group, unit), F.col("blocks")))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    pair = F.least("own", "other") * F.col("blocks") + F.greatest("own", "other")
    return members.withColumn("pair", pair).drop("blocks", "own", "other")


def _from_pivots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many places the sketches of columns 0 and 1 differ, with the other columns."""
    for batch in batches:
        own, pivots = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, SKETCH) for i in range(2))
        apart = (own != pivots).sum(axis=1).astype(np.int64)
        yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(apart)], names=[*batch.schema.names[2:], "apart"])


def _held(members: DataFrame) -> DataFrame:
    """The ``members`` of nodes that hold more than one, with the number ``held``."""
    held = members.groupBy("node").agg(F.count("*").alias("held")).where("held > 1")
    # A merge join at any size; members are shuffled without sketches, as most are alone in their node.
    return stored(members.join(stored(held, "nodes").hint("merge"), "node"), "members")


def candidates(units: DataFrame, node: int = NODE, depth: int = DEPTH, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) between units (``unit``, ``n``, ``tokens``, ``sketch``) that connect all that meet in a node and look alike."""
    columns = ["node", "unit", "held"]
    sketches = units.select("unit", "n", "sketch").hint("merge")
    roots = units.select("unit", F.posexplode("tokens").alias("place", "token"))
    members = _held(roots.select(F.xxhash64("place", "token").alias("node"), "unit"))
    met, large, found = members.where(F.col("held") <= node), members.where(F.col("held") > node), None
    values = [F.substring("sketch", F.pmod(F.xxhash64("node", F.lit(i)), F.lit(SKETCH)).cast("int") + 1, F.lit(1)) for i in range(BRANCHES)]
    children = F.array(*[F.xxhash64("node", F.lit(i), value) for i, value in enumerate(values)]).alias("children")
    for _ in range(depth):
        if large.isEmpty():
            break
        pivots = large.groupBy("node").agg(F.min(F.struct(F.xxhash64("node", "unit").alias("turn"), "unit")).alias("pivot"))
        centers = units.select(F.col("unit").alias("pivot"), F.col("sketch").alias("center"))
        pivots = stored(pivots.select("node", F.col("pivot.unit").alias("pivot")).join(centers, "pivot"), "pivots")
        near = large.join(sketches, "unit").join(pivots, "node").select("sketch", "center", "node", "unit", "pivot", children)
        near = near.mapInArrow(_from_pivots, "node long, unit long, pivot long, children array<long>, apart long")
        near = stored(near, "from-pivots")
        edges = near.where(F.col("apart") <= CLOSE + SKETCH - AGREE).select(F.col("unit").alias("a"), F.col("pivot").alias("b"))
        found = edges if found is None else found.union(edges)
        members = _held(near.where(F.col("apart") > CLOSE).select("node", "unit", "children"))
        met = met.union(members.where(F.col("held") <= node).select(columns))
        members = members.where(F.col("held") > node).select(F.explode("children").alias("node"), "unit")
        members = _held(members)
        met, large = met.union(members.where(F.col("held") <= node)), members.where(F.col("held") > node)
    else:
        met = met.union(large)
    # All nodes of all levels are compared by one job.
    met = _dealt(met.join(sketches, "unit"), "node", "unit", F.ceil(F.col("held") / F.lit(block)))
    met = met.select("node", "pair", "unit", "n", "sketch").repartition("node", "pair").sortWithinPartitions("node", "pair")
    met = met.mapInArrow(_candidates, "a long, b long")
    return met if found is None else found.union(met)


def confirmed(members: list[np.ndarray]) -> list[tuple[int, int]]:
    """Edges of a spanning forest of sets (sorted hashes) that are linked, by their exact intersections."""
    sizes = np.array([len(held) for held in members])
    values, ids = np.unique(np.concatenate(members), return_inverse=True)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    marked = np.zeros(len(values), np.int32)

    def near(member: int, left: np.ndarray) -> np.ndarray:
        own = ids[bounds[member] : bounds[member + 1]]
        linked = np.minimum(sizes[left], len(own)) * 100 >= np.maximum(sizes[left], len(own)) * PERCENT
        fit = left[linked]
        if len(fit):
            marked[own] = 1
            spans = sizes[fit]
            ends = np.cumsum(spans)
            at = np.arange(int(ends[-1])) + np.repeat(bounds[fit] - (ends - spans), spans)
            shared = np.add.reduceat(marked[ids[at]], ends - spans)
            marked[own] = 0
            linked[linked] = shared * 100 >= (spans + len(own) - shared) * PERCENT
        return linked

    return search(len(members), near)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Confirmed edges within each run of equal (family, pair) of sorted batches of texts."""
    group, units, members = None, [], []

    def found() -> pa.RecordBatch:
        return _edges(confirmed(members) if len(members) > 1 else [], np.array(units, np.int64))

    for batch in batches:
        for piece in pieces(batch, 3):
            hashes, bounds = sets_of(piece.column(3))
            for row, of in enumerate(zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True)):
                if of != group:
                    yield found()
                    group, units, members = of, [], []
                units.append(piece.column(2)[row].as_py())
                members.append(hashes[bounds[row] : bounds[row + 1]].copy())
    yield found()


def _named(units: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    """``units`` with the least unit that edges lead to, as ``name``."""
    roots = stored(components(edges), "roots")
    joined = units.join(roots, F.col("unit") == F.col("node"), "left")
    return joined.withColumn(name, F.coalesce("root", "unit")).drop("node", "root")


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_shingles``, ``component_id`` (the least ``key`` of the row's group) and ``kept`` (is it the row's own?)."""
    sets = stored(described(docs, key, text), "sets")
    place = F.struct(F.col("key").isNull().alias("late"), F.coalesce(F.col("key"), F.lit(0).cast(sets.schema["key"].dataType)).alias("number"), "text_key")
    units = sets.where("n > 0").groupBy("d1", "d2", "n")
    units = units.agg(F.min("key").alias("least"), F.min(place).alias("head"), F.first("tokens").alias("tokens"), F.first("sketch").alias("sketch"))
    units = stored(units.withColumn("unit", F.monotonically_increasing_id()), "units")

    edges = stored(candidates(units).where("a != b"), "candidates")
    familied = stored(_named(units.select("unit", "n", "head"), edges, "family"), "familied")
    sizes = familied.groupBy("family").agg(F.sum("n").alias("weight"), F.count("*").alias("held")).where("held > 1")
    sizes = stored(sizes.select("family", F.ceil(F.col("weight") / F.lit(BLOCK_SHINGLES)).alias("parts")), "families")
    heads = stored(familied.join(sizes, "family").select("unit", "family", "parts", "head.*"), "members")
    number = F.coalesce(F.col(key), F.lit(0).cast(docs.schema[key].dataType)).alias("number")
    texts = docs.select(F.col(key).isNull().alias("late"), number, F.xxhash64(text).alias("text_key"), F.col(text).alias("text"))
    # A merge join at any size, so that the plan for small and for large inputs is one.
    texts = _dealt(texts.join(heads.hint("merge"), ["late", "number", "text_key"]), "family", "unit", F.col("parts"))
    texts = texts.select("family", "pair", "unit", "text").repartition("family", "pair").sortWithinPartitions("family", "pair")
    links = stored(texts.mapInArrow(_links, "a long, b long").where("a != b"), "links")

    grouped = stored(_named(units.select("unit", "d1", "d2", "n", "least"), links, "group"), "grouped")
    named = stored(grouped.groupBy("group").agg(F.min("least").alias("component_id")), "components")
    named = stored(grouped.join(named, "group").select("d1", "d2", "n", "component_id"), "named")
    found = sets.select("key", "d1", "d2", "n").join(named, ["d1", "d2", "n"], "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key"))
    return found.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), own.alias("component_id"), own.eqNullSafe(F.col("key")).alias("kept"))
