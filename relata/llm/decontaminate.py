"""Benchmark decontamination: which documents hold a test item, by size-partitioned MinHash containment search.

Words are runs of letters, digits and characters beyond ASCII, with A-Z lower-cased. A text's shingles are its distinct
runs of five words; a text of fewer words has one shingle, its whole sequence. A document holds an item if at least
0.8 of the item's shingles are among its own.

A sketch that treats both sides alike would need as many hashes as the longest document has shingles to see a short item
in it. So only the item is sketched: its least hashes are looked up among all shingles of a document. Items are
partitioned by their number of shingles n; as a document that holds an item lacks at most n - ceil(0.8 n) of its
shingles, that many least hashes and one more cannot all be absent, and no holder is missed. Documents with too few
shingles for an item's size are passed over. What is found is verified by counting the item's shingles, compared as text.

Items are taken in blocks of bounded size (``BLOCK_BYTES``), each of which is sent to all tasks and held against all
documents in one pass without a shuffle; so no document, word or passage is too frequent for a task.

Defined results: null texts are empty; an empty text holds nothing and is held by none; items with equal words are found
together; rows with equal or null ids are each searched for themselves; further columns are ignored by ``search`` and
kept by ``clean``; empty tables give an empty table, or all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relata.llm.frames import map_texts, offsets_of, pieces
from relata.llm.hashing import ALNUM, shingle_hashes, text_bounds, word_hashes, word_places

SHINGLE = 5
CONTAINMENT = 0.8
#: Text bytes of the items in a block, at most, but for a single longer item.
BLOCK_BYTES = 4 << 20
#: Size of the table that rules out most shingles before the search for their exact hashes.
SIEVE_BITS = 22


def needed(size: int) -> int:
    """The least number of ``size`` shingles that makes the threshold."""
    return -(-size * 4 // 5)


def sketch_size(size: int) -> int:
    """How many least hashes of ``size`` cannot all be absent from a holder."""
    return size - needed(size) + 1


class Shingles:
    """The shingles of each text of an Arrow array, as hashes, and as text on demand."""

    def __init__(self, texts: pa.Array) -> None:
        self.data, marks = offsets_of(texts)
        self.starts, self.ends = word_places(self.data, marks, ALNUM)
        self.words = word_hashes(self.data, self.starts, self.ends, ALNUM)
        self.bounds = text_bounds(self.starts, marks)
        counts = np.diff(self.bounds)
        hashes = shingle_hashes(self.words, SHINGLE)
        # A run of five belongs to a text if it ends in it.
        owner = np.repeat(np.arange(len(counts)), counts)
        inside = owner[: len(hashes)] == owner[SHINGLE - 1 :] if len(hashes) else np.zeros(0, bool)
        self.at, self.hashes, self.owner = np.flatnonzero(inside), hashes[inside], owner[: len(hashes)][inside]
        short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
        if len(short):
            low = self.bounds[short]
            extra = [shingle_hashes(self.words[a : a + n], int(n))[0] for a, n in zip(low, counts[short], strict=True)]
            # Those of fewer words never meet a run of five.
            extra = np.array(extra, np.uint64) ^ counts[short].astype(np.uint64)
            self.at, self.hashes, self.owner = (np.concatenate(x) for x in ((self.at, low), (self.hashes, extra), (self.owner, short)))
            order = np.argsort(self.owner, kind="stable")
            self.at, self.hashes, self.owner = self.at[order], self.hashes[order], self.owner[order]
        self.counts = counts

    def of(self, text: int) -> slice:
        return slice(*np.searchsorted(self.owner, [text, text + 1]))

    def written(self, text: int, at: int) -> bytes:
        """The words of the shingle that begins with word ``at`` of ``text``."""
        last = at + min(SHINGLE, int(self.counts[text]))
        return b" ".join(ALNUM[self.data[a:b]].tobytes() for a, b in zip(self.starts[at:last], self.ends[at:last], strict=True))


@dataclass
class Partition:
    """Items whose number of shingles has the same binary length, by the least hashes that stand for them."""

    least_size: int
    hashes: np.ndarray
    items: np.ndarray


@dataclass
class Block:
    """Some items, ready to be searched: their shingles, ids, size partitions and sieve."""

    ids: list[list] = field(default_factory=list)
    shingles: list[dict[int, set[bytes]]] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)
    parts: list[Partition] = field(default_factory=list)
    sieve: np.ndarray | None = None

    @classmethod
    def build(cls, ids: list, texts: list[str | None]) -> Block:
        block, known = cls(), {}
        found = Shingles(pa.array([text or "" for text in texts], pa.string()))
        for text, key in enumerate(ids):
            span = found.of(text)
            grouped: dict[int, set[bytes]] = {}
            for at, value in zip(found.at[span].tolist(), found.hashes[span].tolist(), strict=True):
                grouped.setdefault(value, set()).add(found.written(text, at))
            if not grouped:
                continue
            same = frozenset(shingle for group in grouped.values() for shingle in group)
            if same in known:
                block.ids[known[same]].append(key)
                continue
            known[same] = len(block.ids)
            block.ids.append([key])
            block.shingles.append(grouped)
            block.sizes.append(len(same))
        classes: dict[int, list[int]] = {}
        for item, size in enumerate(block.sizes):
            classes.setdefault(size.bit_length(), []).append(item)
        for items in classes.values():
            least, hashes, owners = min(block.sizes[item] for item in items), [], []
            for item in items:
                own = sorted(block.shingles[item])[: sketch_size(block.sizes[item])]
                hashes += own
                owners += [item] * len(own)
            order = np.argsort(np.array(hashes, np.uint64), kind="stable")
            block.parts.append(Partition(least, np.array(hashes, np.uint64)[order], np.array(owners)[order]))
        block.sieve = np.zeros(1 << SIEVE_BITS, bool)
        for part in block.parts:
            block.sieve[(part.hashes >> np.uint64(64 - SIEVE_BITS)).astype(np.int64)] = True
        return block

    def held_by(self, texts: pa.Array) -> list[tuple[int, int, int]]:
        """(text, item, shared shingles) of each text that holds an item."""
        found = Shingles(texts)
        if not len(found.hashes):
            return []
        near = np.flatnonzero(self.sieve[(found.hashes >> np.uint64(64 - SIEVE_BITS)).astype(np.int64)])
        hashes, owners = found.hashes[near], found.owner[near]
        totals = np.bincount(found.owner, minlength=len(texts))
        candidates = set()
        for part in self.parts:
            large = totals[owners] >= needed(part.least_size)
            values, texts_of = hashes[large], owners[large]
            low, high = np.searchsorted(part.hashes, values, side="left"), np.searchsorted(part.hashes, values, side="right")
            for hit in np.flatnonzero(high > low):
                candidates.update((int(texts_of[hit]), int(item)) for item in part.items[low[hit] : high[hit]])
        rows = []
        for text, item in sorted(candidates):
            span = found.of(text)
            own = self.shingles[item]
            wanted = np.fromiter(own, np.uint64, len(own))
            shared = set()
            for at, value in zip(*(x[np.isin(found.hashes[span], wanted)].tolist() for x in (found.at[span], found.hashes[span])), strict=True):
                written = found.written(text, at)
                if written in own[value]:
                    shared.add(written)
            if len(shared) >= needed(self.sizes[item]):
                rows.append((text, item, len(shared)))
        return rows


def blocks(items: DataFrame, key: str, text: str) -> Iterator[Block]:
    """The items in blocks of bounded size, read one after the other."""
    ids, texts, size = [], [], 0
    for row in items.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text is not null").toLocalIterator():
        if ids and size + len(row.text) > BLOCK_BYTES:
            yield Block.build(ids, texts)
            ids, texts, size = [], [], 0
        ids.append(row.key)
        texts.append(row.text)
        size += len(row.text)
    if ids:
        yield Block.build(ids, texts)


def search(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """One row for each document and item it holds: ids, ``n_shared``, ``n_shingles`` of the item, ``containment``."""
    kind, item_kind = docs.schema[key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    schema = f"{key} {kind}, {item_key} {item_kind}, n_shared long, n_shingles long, containment double"
    context, out = docs.sparkSession.sparkContext, None
    for block in blocks(items, item_key, item_text):
        sent = context.broadcast(block)

        def work(piece: pa.RecordBatch, sent=sent) -> list:
            block, keys = sent.value, piece.column(0)
            rows = [(r, i, n, block.sizes[item]) for r, item, n in block.held_by(piece.column(1)) for i in block.ids[item]]
            at, ids, shared, sizes = zip(*rows, strict=True) if rows else ((), (), (), ())
            return [
                keys.take(pa.array(at, pa.int64())),
                list(ids),
                list(shared),
                list(sizes),
                [n / size for n, size in zip(shared, sizes, strict=True)],
            ]

        found = map_texts(docs, [key, text], schema, work)
        out = found if out is None else out.union(found)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def clean(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    place, context = docs.columns.index(text), docs.sparkSession.sparkContext
    for block in blocks(items, item_key, item_text):
        sent = context.broadcast(block)

        def run(batches, sent=sent):
            for batch in batches:
                low = 0
                for piece in pieces(batch, place):
                    stays = np.ones(piece.num_rows, bool)
                    stays[[row for row, _, _ in sent.value.held_by(piece.column(place))]] = False
                    # From the batch itself, where null texts are still null.
                    yield batch.slice(low, piece.num_rows).filter(pa.array(stays))
                    low += piece.num_rows

        docs = docs.mapInArrow(run, docs.schema)
    return docs
