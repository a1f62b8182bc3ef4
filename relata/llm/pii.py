"""Personal data: exact patterns, and a skip-chain conditional random field that adds what a document implies.

The base spans are what the patterns of e-mail addresses, IP addresses, card and phone numbers match and their checks
accept. The field labels the *active* tokens of a document, those that hold a digit, ``@`` or ``+``; all others are
clamped to no label, which cuts the chain exactly. Neighbouring active tokens share chain potentials. All active tokens of
one normal form (letters and digits, folded), or with the same last seven digits, are a group, however far apart. Where a
pattern matched some token of a group, that is known: each other token of it gets the skip potentials with that kind, at
once and once. Other groups of two share skip potentials, larger ones do so with one node of the group, so any evidence
reaches all of a group in two rounds and edges stay linear. Loopy sum-product message passing goes on until messages
change by less than ``TOLERANCE``. Runs of tokens whose label has at least ``LEAST_SHARE`` of the belief are added where
they overlap no base span.

The field learns from the base spans of at most ``SAMPLE`` documents with active tokens, those with the least hashes of
their ids, by ascent of the pseudo-likelihood: each token given its neighbours. In that the patterns' own verdicts are
hidden for half of the tokens, so shapes, cues and neighbours get weights of their own.

Defined results: null texts are empty and have no spans; positions are code points; overlapping base spans of different
kinds all stay; equal rows each get their result; further columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relata.llm.frames import map_texts

KINDS = ("email", "ip", "card", "phone")
#: Documents the field learns from, and active tokens one of them has, at most.
SAMPLE, SAMPLE_TOKENS = 1500, 400
ROUNDS, RATE, RIDGE = 200, 0.1, 1e-3
#: The change of messages at which their passing ends, the share of the old message in the new one, and the belief a label needs.
TOLERANCE, DAMPING, LEAST_SHARE = 1e-5, 0.3, 0.9
#: Messages that have not settled after ``CALM`` rounds are damped more by this factor from round to round, so that they do.
CALM, CALMER = 50, 0.97

# The patterns of the base, with runs that can be left early cut to linear work.
EMAIL_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
ACTIVE = re.compile(r"[0-9@+]")
#: Words that often stand before personal data, by kind.
CUES = {
    "email": {"mail", "email", "e-mail", "address", "contact", "write"},
    "ip": {"ip", "host", "server", "address", "from"},
    "card": {"card", "visa", "credit", "number", "account", "payment"},
    "phone": {"phone", "tel", "telephone", "call", "fax", "mobile", "cell"},
}

Span = tuple[int, int, int]


def emails(text: str) -> list[tuple[int, int]]:
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > end and text[begin - 1] in EMAIL_LOCAL:
            begin -= 1
        domain = EMAIL_DOMAIN.match(text, at) if begin < at else None
        if domain:
            end = domain.end()
            found.append((begin, end))
        at = text.find("@", max(at + 1, end))
    return found


def small_part(part: str) -> bool:
    kept = part.lstrip("0")
    return len(kept) < 4 and int(kept or "0") < 256


def passes_luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(x), 10)) for x in digits[-2::-2])
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(x for x in text if "0" <= x <= "9")


def is_card(text: str) -> bool:
    digits = digits_of(text)
    return 16 <= len(digits) <= 19 and passes_luhn(digits)


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) of what patterns and checks find, by kind, then start."""
    found = [(0, *span) for span in emails(text)]
    found += [(1, *m.span()) for m in IP.finditer(text) if all(map(small_part, m[0].split(".")))]
    found += [(2, *m.span()) for m in CARD.finditer(text) if is_card(m[0])]
    found += [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits_of(m[0])) <= 15]
    return found


#: Features of a token: shape counts, neighbours, cues, and whether it lies in a base span of each kind.
GROUPS = {"digits": 9, "marks": 6, "letters": 3, "before": 3, "after": 3, "checked": 3, "opens": 3}
STARTS = dict(zip(GROUPS, np.cumsum([0, *GROUPS.values()])[:-1].tolist(), strict=True))
CUE_START = sum(GROUPS.values())
BASE_START = CUE_START + len(KINDS)
BIAS = BASE_START + len(KINDS)
FEATURES = BIAS + 1
LABELS = len(KINDS) + 1
#: The kind of "checked" for a token that looks like an address or a card and fails the check; it cannot be either.
FAILED, RULED_OUT = 2, -30.0


@dataclass
class Tokens:
    """Active tokens of a document: places, features (a row of 0 and 1 each), base labels, chain edges, skip edges to the
    next token of a group, and the groups."""

    places: list[tuple[int, int]]
    features: np.ndarray
    labels: np.ndarray
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]
    groups: list[list[int]] = field(default_factory=list)


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """The token without punctuation around it; a plus and an opening bracket before digits belong to it."""
    while start < end and not (text[start].isalnum() or text[start] in "+("):
        start += 1
    while end > start and not text[end - 1].isalnum():
        end -= 1
    return start, end


def read_tokens(text: str, spans: list[Span]) -> Tokens:
    words = [m.span() for m in TOKEN.finditer(text)]
    active = [i for i, (a, b) in enumerate(words) if ACTIVE.search(text, a, b)]
    number = len(active)
    features, labels = np.zeros((number, FEATURES), np.uint8), np.zeros(number, np.int64)
    places, chain, skip = [], [], []
    groups: dict[str, list[int]] = {}
    by_start = [sorted((a, b) for kind, a, b in spans if kind == k) for k in range(len(KINDS))]
    for i, word in enumerate(active):
        a, b = words[word]
        places.append(trimmed(text, a, b))
        token = text[a:b]
        digits = digits_of(token)
        row = features[i]
        row[BIAS] = 1
        row[STARTS["digits"] + min(8, len(digits).bit_length() * 2 - (len(digits) % 2))] = 1
        marks = 1 if "@" in token else 2 if token.count(".") >= 3 else 3 if "+" in token else 4 if "-" in token or "(" in token else 5 if "." in token[:-1] else 0
        row[STARTS["marks"] + marks] = 1
        letters = sum(map(str.isalpha, token))
        row[STARTS["letters"] + (0 if not letters else 1 if letters < len(token) / 2 else 2)] = 1
        for name, other in (("before", word - 1), ("after", word + 1)):
            edge = not 0 <= other < len(words)
            row[STARTS[name] + (0 if edge else 1 if ACTIVE.search(text, *words[other]) else 2)] = 1
        dotted = IP.fullmatch(text, *places[-1])
        passes = is_card(token) or (dotted and all(map(small_part, dotted[0].split("."))))
        row[STARTS["checked"] + (1 if passes else FAILED if dotted or len(digits) >= 12 else 0)] = 1
        row[STARTS["opens"] + (1 if token[0] == "+" else 2 if token[0] == "(" else 0)] = 1
        if word:
            cue = text[slice(*words[word - 1])].lower().strip(".:,;()[]")
            for k, kind in enumerate(KINDS):
                row[CUE_START + k] = cue in CUES[kind]
        for k in reversed(range(len(KINDS))):
            near = bisect_left(by_start[k], (b, 0)) - 1
            if near >= 0 and by_start[k][near][1] > a:
                row[BASE_START + k] = 1
                labels[i] = k + 1
        if i and active[i - 1] == word - 1:
            chain.append((i - 1, i))
        folded = "".join(x for x in token.lower() if x.isalnum())
        forms = {folded} if len(folded) >= 4 else set()
        if len(digits) >= 7:
            forms.add(digits[-7:])
        for form in forms:
            held = groups.setdefault(form, [])
            if held:
                skip.append((held[-1], i))
            held.append(i)
    # Two forms may have the same tokens; they are one group.
    distinct = sorted({tuple(held) for held in groups.values() if len(held) > 1})
    return Tokens(places, features, labels, chain, sorted(set(skip)), list(map(list, distinct)))


@dataclass
class Field:
    """Weights of features by label, and potentials of chain and skip edges (symmetric for skips)."""

    weights: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def beliefs(self, tokens: Tokens) -> np.ndarray:
        """Each token's label distribution after loopy message passing."""
        scores = tokens.features @ self.weights
        number, skip, known, stars = len(scores), set(), set(), 0
        for group in tokens.groups:
            kinds = {int(tokens.labels[i]) for i in group} - {0}
            if kinds:
                known |= {(i, kind) for i in group if not tokens.labels[i] for kind in kinds}
            elif len(group) == 2:
                skip.add((group[0], group[1]))
            else:
                skip |= {(i, number + stars) for i in group}
                stars += 1
        scores = np.concatenate([scores, np.zeros((stars, LABELS))])
        for i, kind in known:
            scores[i] += self.skip[kind]
        edges = np.array(tokens.chain + sorted(skip), np.int64).reshape(-1, 2)
        if len(edges):
            links = np.concatenate([np.repeat(self.chain[None], len(tokens.chain), 0), np.repeat(self.skip[None], len(skip), 0)])
            source = np.concatenate([edges[:, 0], edges[:, 1]])
            target = np.concatenate([edges[:, 1], edges[:, 0]])
            links = np.concatenate([links, links.transpose(0, 2, 1)])
            back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
            messages, share, turn, change = np.zeros((len(source), LABELS)), 1 - DAMPING, 0, np.inf
            while change >= TOLERANCE:
                total = scores.copy()
                np.add.at(total, target, messages)
                sent = _log_sum((total[source] - messages[back])[:, :, None] + links, 1)
                sent -= _log_sum(sent, 1)[:, None]
                step = share * (sent - messages)
                messages, change, turn = messages + step, np.abs(step).max(), turn + 1
                share *= CALMER if turn > CALM else 1
            scores = scores.copy()
            np.add.at(scores, target, messages)
        scores = scores[:number]
        return np.exp(scores - _log_sum(scores, 1)[:, None])


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(values - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit(documents: list[Tokens]) -> Field:
    """The field of labelled tokens, by ascent of the pseudo-likelihood."""
    # Inputs of a token: features, labels of the left, of the right chain neighbour, and of skip neighbours.
    rows, labels = [], []
    for tokens in documents:
        around = np.zeros((len(tokens.labels), 3 * LABELS))
        for a, b in tokens.chain:
            around[b, tokens.labels[a]] += 1
            around[a, LABELS + tokens.labels[b]] += 1
        for a, b in tokens.skip:
            around[b, 2 * LABELS + tokens.labels[a]] += 1
            around[a, 2 * LABELS + tokens.labels[b]] += 1
        rows.append(np.concatenate([tokens.features, around], axis=1))
        labels.append(tokens.labels)
    empty = Field(np.zeros((FEATURES, LABELS)), np.zeros((LABELS, LABELS)), np.zeros((LABELS, LABELS)))
    empty.weights[BIAS, 0] = 9.0
    if not documents or not any(map(np.any, labels)):
        return empty
    inputs, wanted = np.concatenate(rows), np.concatenate(labels)
    hidden = np.arange(len(inputs)) % 2 == 0
    inputs[hidden, BASE_START : BASE_START + len(KINDS)] = 0
    goal = np.eye(LABELS)[wanted]
    weights = np.zeros((inputs.shape[1], LABELS))
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for turn in range(1, ROUNDS + 1):
        scores = inputs @ weights
        guess = np.exp(scores - _log_sum(scores, 1)[:, None])
        slope = inputs.T @ (goal - guess) / len(inputs) - RIDGE * weights
        # A chain potential is one table, seen from both its ends.
        pair = slope[FEATURES : FEATURES + LABELS] + slope[FEATURES + LABELS : FEATURES + 2 * LABELS].T
        slope[FEATURES : FEATURES + LABELS], slope[FEATURES + LABELS : FEATURES + 2 * LABELS] = pair, pair.T
        skips = slope[FEATURES + 2 * LABELS :]
        slope[FEATURES + 2 * LABELS :] = (skips + skips.T) / 2
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * np.square(slope)
        weights += RATE * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.99**turn)) + 1e-8)
    weights[STARTS["checked"] + FAILED, [1 + KINDS.index("ip"), 1 + KINDS.index("card")]] = RULED_OUT
    return Field(weights[:FEATURES], weights[FEATURES : FEATURES + LABELS], weights[FEATURES + 2 * LABELS :])


def added_spans(text: str, base: list[Span], field: Field) -> list[Span]:
    """Runs of neighbouring tokens with one sure label that overlap no base span."""
    tokens = read_tokens(text, base)
    if not tokens.places:
        return []
    beliefs = field.beliefs(tokens)
    best = np.where(beliefs.max(axis=1) >= LEAST_SHARE, beliefs.argmax(axis=1), 0)
    joined, runs = set(tokens.chain), []
    for i, (a, b) in enumerate(tokens.places):
        if not best[i] or a >= b:
            continue
        if runs and runs[-1][3] == i - 1 and (i - 1, i) in joined and best[i - 1] == best[i]:
            runs[-1] = (runs[-1][0], runs[-1][1], b, i)
        else:
            runs.append((int(best[i]) - 1, a, b, i))
    taken = sorted((a, b) for _, a, b in base)
    reach = np.maximum.accumulate([b for _, b in taken]).tolist() if taken else []
    found = []
    for kind, a, b, _ in runs:
        before = bisect_left(taken, (b, 0)) - 1
        if before < 0 or reach[before] <= a:
            found.append((kind, a, b))
    return found


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end in spans)


def train(docs: DataFrame, key: str = "doc_id", text: str = "text") -> Field:
    """The field of the base spans of a bounded sample of ``docs``."""
    some = docs.select(F.col(key), F.col(text).alias("text")).where(F.regexp_like("text", F.lit(ACTIVE.pattern)))
    ids = some.select(key).where(F.col(key).isNotNull()).distinct().orderBy(F.xxhash64(key), key).limit(SAMPLE)
    # At most SAMPLE ids, so the broadcast is bounded.
    sample = some.join(F.broadcast(ids), key).distinct()

    def work(piece: pa.RecordBatch) -> list:
        read = [read_tokens(x, base_spans(x)) for x in piece.column(0).to_pylist()]
        read = [x if len(x.labels) <= SAMPLE_TOKENS else None for x in read]
        flat = lambda pairs: [place for pair in pairs for place in pair]
        return [
            [x and x.features.reshape(-1).tobytes() for x in read],
            [x and x.labels.tolist() for x in read],
            [x and flat(x.chain) for x in read],
            [x and flat(x.skip) for x in read],
        ]

    schema = "features binary, labels array<long>, chain array<long>, skip array<long>"
    rows = map_texts(sample, ["text"], schema, work).where("features is not null")
    # Sorted, so that the fit does not depend on the order in which tasks end.
    table = rows.orderBy(F.xxhash64("features", "labels")).limit(SAMPLE).toArrow().to_pylist()
    pairs = lambda flat: list(zip(flat[::2], flat[1::2], strict=True))
    documents = [
        Tokens([], np.frombuffer(row["features"], np.uint8).reshape(-1, FEATURES), np.array(row["labels"]), pairs(row["chain"]), pairs(row["skip"]))
        for row in table
    ]
    return fit(documents)


def find(docs: DataFrame, field: Field, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, base counts ``n_email`` to ``n_phone``, ``base_sha256`` of the joined base spans, all ``spans``, ``n_added``."""
    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    schema = f"{key} {docs.schema[key].dataType.simpleString()}, {counts}, base_sha256 string, spans string, n_added long"
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def work(piece: pa.RecordBatch) -> list:
        found = []
        for text in piece.column(1).to_pylist():
            if not ACTIVE.search(text):
                found.append(([], []))
                continue
            base = base_spans(text)
            found.append((base, added_spans(text, base, sent.value)))
        base = [joined(spans) for spans, _ in found]
        return [
            piece.column(0),
            *[[sum(span[0] == kind for span in spans) for spans, _ in found] for kind in range(len(KINDS))],
            [hashlib.sha256(x.encode()).hexdigest() for x in base],
            [joined(sorted(spans + more)) if more else own for own, (spans, more) in zip(base, found, strict=True)],
            [len(more) for _, more in found],
        ]

    return map_texts(docs, [key, text], schema, work)
