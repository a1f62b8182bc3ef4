"""Near-duplicate documents by SimHash, with pigeonring filtering of the candidates.

A fingerprint has 64 bits, in a ring of four segments of 16. If two fingerprints differ in at most 3 bits, there is a
segment from which every chain of n segments differs in at most 3n/4 bits: 0 in the first, 1 in two, 2 in three, 3 in
all. So one segment is equal, and one half of the next, as one bit is left for it: these 24 bits are the key under which
pairs meet (eight keys a fingerprint). What meets is tested chain by chain before its full distance counts.

Equal fingerprints are one unit. A key with many units is dealt into blocks; each pair of blocks is a group of bounded
size of its own, in which a breadth-first search gives a spanning forest, never all pairs. The forests' edges go to
``components``.

Defined results: a null or empty text, or one without words, has fingerprint zero and links as any other; rows with
one id or with null ids are fingerprinted each for itself, and a group with null ids only has a null component; of
each component ``one_per_group`` keeps one row, also where ids are null or several texts have one id;
further columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relata.llm.components import components
from relata.llm.frames import map_texts, stored

SEED = 42
SHINGLE = 3
DISTANCE = 3
SEGMENTS = 4
SEGMENT_BITS = 64 // SEGMENTS
#: Units of a key that one group compares; a larger key is dealt into blocks of about this size.
BLOCK = 2048


def fingerprint(text: bytes) -> bytes:
    """The eight bytes of a text's SimHash, highest first."""
    words = text.lower().split()
    if not words:
        return bytes(8)
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(words, words[1:], words[2:], strict=False))
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(shingle, SEED) for shingle in shingles])
    counts = np.zeros(64, np.int64)
    count = len(hashes) // 8
    for start in range(0, len(hashes), 8 << 16):
        bits = np.unpackbits(np.frombuffer(hashes[start : start + (8 << 16)], np.uint8)).reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int32)
    return np.packbits(counts * 2 > count).tobytes()


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the fingerprint of each row's whole text as a signed 64-bit ``print``."""

    def work(piece: pa.RecordBatch) -> list:
        found = b"".join(map(fingerprint, piece.column(1).cast(pa.binary()).to_pylist()))
        return [piece.column(0), pa.array(np.frombuffer(found, ">i8").astype(np.int64))]

    return map_texts(docs, [key, text], f"{key} {docs.schema[key].dataType.simpleString()}, print long", work)


def meeting_keys(value: Column) -> Column:
    """The eight keys of a fingerprint: which segment, which half of the next one, and their bits."""
    keys = []
    for first in range(SEGMENTS):
        second = (first + 1) % SEGMENTS
        equal = F.shiftrightunsigned(value, SEGMENT_BITS * first).bitwiseAND(F.lit(0xFFFF))
        for half in range(2):
            part = F.shiftrightunsigned(value, SEGMENT_BITS * second + 8 * half).bitwiseAND(F.lit(0xFF))
            place = F.lit((first * 2 + half) << 24)
            keys.append(place.bitwiseOR(F.shiftleft(equal, 8)).bitwiseOR(part))
    return F.array(*keys)


def linked(left: np.ndarray, right: np.ndarray, first: int) -> np.ndarray:
    """Which pairs keep within the budget of every chain that starts at segment ``first``, the full one being the distance."""
    ring = np.bitwise_xor(left, right)
    mask, spent, passed = np.uint64(0xFFFF), 0, True
    for place in range(SEGMENTS):
        segment = np.uint64(SEGMENT_BITS * ((first + place) % SEGMENTS))
        spent = spent + np.bitwise_count((ring >> segment) & mask)
        passed = passed & (spent <= math.floor((place + 1) * DISTANCE / SEGMENTS))
        if not np.any(passed):
            break
    return passed


def forest(units: np.ndarray, first: int) -> list[np.ndarray]:
    """Edges of a spanning forest of the units that are linked, by breadth-first search."""
    left, edges = units[1:], []
    pending = [units[0]]
    while len(left):
        if not pending:
            pending.append(left[0])
            left = left[1:]
            continue
        unit = pending.pop()
        near = linked(left, unit, first)
        if np.any(near):
            found = left[near]
            edges.append(np.stack([np.full(len(found), unit), found]))
            pending.extend(found)
            left = left[~near]
    return edges


def _links(batches):
    """Edges within each run of equal (key, low, high) of sorted batches; a run may go on in the next batch."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    held = np.zeros((2, 0), np.int64)
    held_units = np.zeros(0, np.uint64)

    def found(groups: np.ndarray, units: np.ndarray, complete: bool):
        change = np.flatnonzero(np.any(groups[:, 1:] != groups[:, :-1], axis=0)) + 1
        starts = np.concatenate([[0], change])
        ends = np.concatenate([change, [len(units)]])
        if not complete:
            starts, ends = starts[:-1], ends[:-1]
        edges = []
        pairs = starts[ends - starts == 2]
        firsts = groups[0, pairs] >> 25
        for first in range(SEGMENTS):
            some = pairs[firsts == first]
            if len(some):
                near = linked(units[some], units[some + 1], first)
                edges.append(np.stack([units[some], units[some + 1]])[:, near])
        for start, end in zip(starts, ends, strict=True):
            if end - start > 2:
                edges.extend(forest(units[start:end], int(groups[0, start] >> 25)))
        done = np.concatenate(edges, axis=1).view(np.int64) if edges else np.zeros((2, 0), np.int64)
        rest = len(units) if complete else (change[-1] if len(change) else 0)
        return pa.RecordBatch.from_arrays([pa.array(done[0]), pa.array(done[1])], schema=schema), rest

    for batch in batches:
        if not batch.num_rows:
            continue
        groups = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
        held = np.concatenate([held, groups], axis=1)
        held_units = np.concatenate([held_units, batch.column(2).to_numpy().view(np.uint64)])
        edges, rest = found(held, held_units, False)
        held, held_units = held[:, rest:], held_units[rest:]
        yield edges
    if len(held_units):
        yield found(held, held_units, True)[0]


def near_links(units: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints in ``print`` that connect all that differ in at most three bits."""
    met = units.select(F.explode(meeting_keys(F.col("print"))).alias("key"), "print")
    shared = stored(met.groupBy("key").agg(F.count("*").alias("held")).where("held > 1"), "shared-keys")
    met = met.join(shared, "key")
    blocks = F.ceil(F.col("held") / F.lit(BLOCK)).cast("long")
    met = met.select("key", "print", blocks.alias("blocks"), F.pmod(F.xxhash64("print"), blocks).alias("own"))
    met = met.select("key", "print", "blocks", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    pair = F.least("own", "other") * F.col("blocks") + F.greatest("own", "other")
    met = met.select(F.col("key").cast("long").alias("key"), pair.alias("pair"), "print")
    met = met.repartition("key", "pair").sortWithinPartitions("key", "pair")
    return met.mapInArrow(_links, "a long, b long")


def _grouped(units: DataFrame) -> DataFrame:
    """``units`` (``print``, ``least``) with the ``root`` of their components."""
    units = stored(units, "units")
    roots = stored(components(near_links(units)), "roots")
    rooted = units.join(roots, F.col("print") == F.col("node"), "left")
    return stored(rooted.select("print", "least", F.coalesce("root", "print").alias("root")), "rooted")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``fingerprint`` (16 hexadecimal digits) and ``component_id``, the least ``key`` of the row's component."""
    prints = stored(fingerprints(docs, key, text), "fingerprints")
    rooted = _grouped(prints.groupBy("print").agg(F.min(key).alias("least")))
    heads = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "heads")
    named = stored(rooted.join(heads, "root").select("print", "component_id"), "named")
    found = prints.join(named, "print")
    return found.select(key, F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component one, that with the least key (null ids last), then the least hash of
    its text, then of its other columns."""
    place = ["late", "number", "text_key"]
    number = F.coalesce(F.col(key), F.lit(0).cast(docs.schema[key].dataType)).alias("number")
    owner = [F.col(key).isNull().alias("late"), number, F.xxhash64(text).alias("text_key")]
    # An id alone does not tell rows apart; equal texts have one fingerprint, so a place lies in one component.
    owned = docs.select(F.struct(*owner).alias("place"), F.col(text).alias("text"))
    prints = fingerprints(owned, "place", "text")
    rooted = _grouped(prints.groupBy("print").agg(F.min("place").alias("least")))
    heads = stored(rooted.groupBy("root").agg(F.min("least").alias("head")).select("head.*"), "kept-places")
    # The row is wrapped, so that its columns may have any names. Texts are shuffled once, for the join and repeated places.
    rows = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"), *owner)
    others = [F.col(f"row.`{name}`") for name in docs.columns if name not in (key, text)]
    tie = F.xxhash64(F.to_json(F.struct(*others))) if others else F.lit(0)
    kept = rows.join(heads.hint("merge"), place, "left_semi").groupBy(*place).agg(F.min_by("row", tie).alias("row"))
    return kept.select(*[F.col(f"row.`{name}`").alias(name) for name in docs.columns])
