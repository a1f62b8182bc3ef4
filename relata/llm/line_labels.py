"""Quality rules: counts of words and lines, and a linear-chain conditional random field over the lines.

The field marks each line with words as content or boilerplate; its states depend on the line's features and on the
state before. A document is kept if the base rules pass and lines marked as content hold at least ``CONTENT_SHARE`` of
its words. The best marks of a document come from Viterbi decoding, here for all documents of a piece line by line.

Lines have no labels of their own. The field is fitted on at most ``SAMPLE`` labelled documents, those with the least
hashes of their ids: the lines of one labelled good count as content, those of others as boilerplate. Fitting maximises
the exact conditional likelihood, by gradient ascent over forward-backward sums. Counting and marking is a map over all
rows; the model has a fixed size.

Defined results: a null text is empty; an empty text fails the base rules; without labels of both kinds every line is
content; of several labels of an id the least counts; equal rows each get their result; further columns are ignored; an
empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relata.llm.frames import map_texts, offsets_of
from relata.llm.hashing import ALL, EXACT, mix, shingle_hashes, text_bounds, word_hashes, word_places

LEAST_WORDS = 50
#: Repeated words may be this many hundredths of all words.
MOST_REPEATED = 50
CONTENT_SHARE = 0.5
#: Labelled documents the field is fitted on, at most.
SAMPLE = 1500
ROUNDS = 150
RATE = 0.15
#: Weight of the squared parameters, against the mean likelihood of a line.
RIDGE = 1e-3
CONTENT, BOILERPLATE = 1, 0

SYMBOLS = b"#*$%&|<>"
COUNTED = {"symbol": SYMBOLS, "upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "digit": bytes(range(48, 58)), "bang": b"!", "stop": b".?!:;"}
#: Edges of the shares that sort a line into four kinds by one count, and how many such counts there are.
EDGES = np.array([0.02, 0.12, 0.4])
KINDS = len(EDGES) + 1
#: Features of a line: one out of each of these groups.
GROUPS = {"length": 8, "symbol": KINDS, "upper": KINDS, "digit": KINDS, "bang": KINDS, "stop": KINDS, "echo": KINDS, "again": 2, "place": 3}
STARTS = dict(zip(GROUPS, np.cumsum([0, *GROUPS.values()])[:-1].tolist(), strict=True))
FEATURES = sum(GROUPS.values())


@dataclass
class Counted:
    """Per text: counts of words, their characters, symbols, repeated lines, words in repeated windows. Per line with
    words: its text, its words, and its features."""

    words: np.ndarray
    characters: np.ndarray
    symbols: np.ndarray
    same_lines: np.ndarray
    repeated_words: np.ndarray
    line_text: np.ndarray
    line_words: np.ndarray
    features: np.ndarray


def _sums(flags: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[high] - total[low]


def _later(keys: np.ndarray) -> np.ndarray:
    """Which elements equal an earlier one."""
    _, first = np.unique(keys, return_index=True)
    found = np.ones(len(keys), bool)
    found[first] = False
    return found


def count(texts: pa.Array) -> Counted:
    data, marks = offsets_of(texts)
    number = len(marks) - 1
    starts, ends = word_places(data, marks, EXACT)
    words = word_hashes(data, starts, ends, EXACT)
    bounds = text_bounds(starts, marks)
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(number), sizes)
    # Code points are counted by their first bytes.
    firsts = ((data & 0xC0) != 0x80) & (EXACT[data] > 0)
    is_symbol = np.isin(data, np.frombuffer(SYMBOLS, np.uint8))

    windows = shingle_hashes(words, 3)
    inside = owner[: len(windows)] == owner[2:] if len(windows) else np.zeros(0, bool)
    at = np.flatnonzero(inside)
    keys = windows[at] ^ mix(owner[at].astype(np.uint64) + np.uint64(1))
    _, back, times = np.unique(keys, return_inverse=True, return_counts=True)
    often = at[times[back] > 1]
    repeated = np.zeros(len(words), bool)
    for place in range(3):
        repeated[often + place] = True

    # Lines end at newlines and at the ends of texts.
    cuts = np.flatnonzero(data == 10)
    line_low = np.sort(np.concatenate([marks[:-1], cuts + 1]), kind="stable")
    line_high = np.sort(np.concatenate([marks[1:], cuts]), kind="stable")
    word_low, word_high = np.searchsorted(starts, line_low), np.searchsorted(starts, line_high)
    full = word_high > word_low
    line_low, line_high, word_low, word_high = line_low[full], line_high[full], word_low[full], word_high[full]
    line_text = owner[word_low]
    line_words = word_high - word_low
    hashes = word_hashes(data, line_low, line_high, ALL)
    again = _later(hashes ^ mix(line_text.astype(np.uint64) + np.uint64(1)))

    visible = np.maximum(1, _sums(EXACT[data] > 0, line_low, line_high))
    echoes = np.concatenate([[False], words[1:] == words[:-1]]) if len(words) else np.zeros(0, bool)
    shares = {name: _sums(np.isin(data, np.frombuffer(held, np.uint8)), line_low, line_high) for name, held in COUNTED.items()}
    letters = np.maximum(1, shares["upper"] + shares["lower"])
    shares = {
        "symbol": shares["symbol"] / visible,
        "upper": shares["upper"] / letters,
        "digit": shares["digit"] / visible,
        "bang": shares["bang"] / line_words,
        "stop": shares["stop"] / line_words,
        "echo": _sums(echoes, word_low, word_high) / line_words,
    }
    last = np.concatenate([line_text[1:] != line_text[:-1], [True]]) if len(line_text) else np.zeros(0, bool)
    first = np.concatenate([[True], line_text[1:] != line_text[:-1]]) if len(line_text) else np.zeros(0, bool)
    kinds = {name: np.searchsorted(EDGES, share, side="right") for name, share in shares.items()}
    kinds["length"] = np.minimum(7, np.log2(line_words).astype(np.int64)) if len(line_words) else line_words
    kinds["again"] = again.astype(np.int64)
    kinds["place"] = np.where(first, 0, np.where(last, 2, 1))
    features = np.stack([kinds[name] + STARTS[name] for name in GROUPS], axis=1) if len(line_text) else np.zeros((0, len(GROUPS)), np.int64)
    return Counted(
        sizes,
        _sums(firsts, marks[:-1], marks[1:]),
        _sums(is_symbol, marks[:-1], marks[1:]),
        np.bincount(line_text[again], minlength=number),
        np.bincount(owner[repeated], minlength=number),
        line_text,
        line_words,
        features,
    )


@dataclass
class Field:
    """Weights of features and of neighbouring states; ``steps[a, b]`` is for state a before state b."""

    weights: np.ndarray
    steps: np.ndarray

    def marks(self, features: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """The best states of the lines of all texts, by Viterbi decoding; content wins ties."""
        scores = self.weights[features].sum(axis=1)
        rounds = _rounds(owner)
        best, back = scores.copy(), np.zeros((len(owner), 2), np.int64)
        for before, at in rounds[1:]:
            ways = best[before][:, :, None] + self.steps[None]
            # Argmax over reversed states, so that the higher state wins a tie.
            back[at] = 1 - np.argmax(ways[:, ::-1], axis=1)
            best[at] += ways.max(axis=1)
        found = np.zeros(len(owner), np.int64)
        if len(owner):
            final = np.flatnonzero(np.append(owner[1:] != owner[:-1], True))
            found[final] = (best[final, 1] >= best[final, 0]).astype(np.int64)
            for before, at in reversed(rounds[1:]):
                found[before] = back[at, found[at]]
        return found


def _rounds(owner: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each place in a text, the lines there and the ones before them."""
    if not len(owner):
        return []
    begins = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    lengths = np.diff(np.append(begins, len(owner)))
    place = np.arange(len(owner)) - np.repeat(begins, lengths)
    order = np.argsort(place, kind="stable")
    ends = np.cumsum(np.bincount(place))
    return [(order[low:high] - 1, order[low:high]) for low, high in zip(np.append(0, ends[:-1]), ends, strict=True)]


def _add(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit(features: np.ndarray, owner: np.ndarray, states: np.ndarray) -> Field:
    """The field of lines (in order, by text) with known states, by ascent of the exact likelihood."""
    field = Field(np.zeros((FEATURES, 2)), np.zeros((2, 2)))
    if len(np.unique(states)) < 2:
        return field
    rounds = _rounds(owner)
    linked = np.flatnonzero(owner[1:] == owner[:-1]) + 1
    count = len(owner)
    seen = np.zeros((FEATURES, 2))
    for group in range(features.shape[1]):
        np.add.at(seen, (features[:, group], states), 1)
    seen_steps = np.zeros((2, 2))
    np.add.at(seen_steps, (states[linked - 1], states[linked]), 1)
    moments = [np.zeros((FEATURES, 2)), np.zeros((2, 2))], [np.zeros((FEATURES, 2)), np.zeros((2, 2))]
    for turn in range(1, ROUNDS + 1):
        scores = field.weights[features].sum(axis=1)
        forward, backward = scores.copy(), np.zeros((count, 2))
        for before, at in rounds[1:]:
            forward[at] += _add(forward[before][:, :, None] + field.steps[None], 1)
        for before, at in reversed(rounds[1:]):
            backward[before] = _add(field.steps[None] + (scores[at] + backward[at])[:, None, :], 2)
        total = _add(forward + backward, 1)
        shares = np.exp(forward + backward - total[:, None])
        pairs = forward[linked - 1][:, :, None] + field.steps[None] + (scores[linked] + backward[linked])[:, None, :]
        pairs = np.exp(pairs - total[linked][:, None, None])
        expected = np.zeros((FEATURES, 2))
        for group in range(features.shape[1]):
            for state in (0, 1):
                expected[:, state] += np.bincount(features[:, group], shares[:, state], FEATURES)
        slopes = [(seen - expected) / count - RIDGE * field.weights, (seen_steps - pairs.sum(axis=0)) / count - RIDGE * field.steps]
        for place, (slope, values) in enumerate(zip(slopes, (field.weights, field.steps), strict=True)):
            moments[0][place] = 0.9 * moments[0][place] + 0.1 * slope
            moments[1][place] = 0.99 * moments[1][place] + 0.01 * np.square(slope)
            mean, square = moments[0][place] / (1 - 0.9**turn), moments[1][place] / (1 - 0.99**turn)
            values += RATE * mean / (np.sqrt(square) + 1e-8)
    return field


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Field:
    """The field of the labelled rows of ``docs``."""
    known = labels.where(F.col(label).isin(0, 1)).groupBy(key).agg(F.min(label).cast("long").alias("label"))
    # At most SAMPLE ids, so the broadcast is bounded.
    chosen = known.orderBy(F.xxhash64(key), key).limit(SAMPLE)
    sample = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(chosen), key)
    sample = sample.groupBy(key, "text").agg(F.min("label").alias("label")).select("label", "text")

    def work(piece: pa.RecordBatch) -> list:
        found = count(piece.column(1))
        low = np.searchsorted(found.line_text, np.arange(piece.num_rows + 1)) * len(GROUPS)
        rows = pa.ListArray.from_arrays(pa.array(low.astype(np.int32)), pa.array(found.features.reshape(-1).astype(np.int32)))
        return [piece.column(0), rows]

    held = map_texts(sample, ["label", "text"], "label long, features array<int>", work)
    # Sorted, so that the fit does not depend on the order in which tasks end.
    rows = held.orderBy(F.xxhash64("features"), "label").limit(SAMPLE).toArrow().to_pylist()
    parts = [np.array(row["features"], np.int64).reshape(-1, len(GROUPS)) for row in rows]
    sizes = [len(part) for part in parts]
    features = np.concatenate([np.zeros((0, len(GROUPS)), np.int64), *parts])
    states = np.repeat([row["label"] for row in rows], sizes).astype(np.int64)
    return fit(features, np.repeat(np.arange(len(parts)), sizes), states)


def judge(docs: DataFrame, field: Field, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, the counts, ``base_failed``, ``content_share`` (null without words) and ``kept`` of each row's whole text."""
    schema = (
        f"{key} {docs.schema[key].dataType.simpleString()}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_repeat_words long, base_failed boolean, content_share double, kept boolean"
    )

    def work(piece: pa.RecordBatch) -> list:
        found = count(piece.column(1))
        marks = field.marks(found.features, found.line_text)
        content = np.bincount(found.line_text, found.line_words * (marks == CONTENT), piece.num_rows)
        failed = (found.words < LEAST_WORDS) | (100 * found.repeated_words > MOST_REPEATED * found.words)
        share = content / np.maximum(1, found.words)
        counts = [found.words, found.characters, found.symbols, found.same_lines, found.repeated_words]
        return [
            piece.column(0),
            *[pa.array(x.astype(np.int64)) for x in counts],
            pa.array(failed),
            pa.array(share, mask=found.words == 0),
            pa.array(~failed & (share >= CONTENT_SHARE)),
        ]

    return map_texts(docs, [key, text], schema, work)
