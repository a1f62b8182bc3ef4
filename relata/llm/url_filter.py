"""URL filtering: rules first, then the ratio of two character language models.

The models of accepted and rejected URLs are Markov models of variable order: a character's probability after its three
predecessors mixes with the one after two, one and none, by how often and before how many different characters the
context was seen (Witten-Bell). They are counted over all URLs that a rule decides. A URL's score is the mean, over its
characters and its end, of the log ratio of both models; it is accepted if that reaches a threshold calibrated on URLs the
calibrated models have not counted: a fifth of them, chosen by a hash of the URL. The final models count all.

Characters fall into ``SYMBOLS`` classes, so a model has ``SYMBOLS ** 4`` counts at most, however many URLs there are: that
bounds what is gathered on the driver and sent to the tasks. Counting combines in the map tasks; scoring is a map. No host
is too frequent for a task.

Defined results: a null url, and one without ``://``, has an empty host and path and no rule; a null url is scored as an
empty one; where no rule accepts or none rejects any URL, there is no ratio and all others are allowed; equal rows each get
their result; further columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relata.llm.frames import map_texts, offsets_of

ALLOW, BLOCK = "allow", "block"

#: Characters a URL may hold beside letters and digits, each a class of its own.
MARKS = b".-/?=&#_%:"
BOUND, DIGIT, ASCII, BEYOND = 0, 27, 28 + len(MARKS), 29 + len(MARKS)
SYMBOLS = 30 + len(MARKS)
ORDER = 3
#: Steps of the scores among which the threshold is chosen.
STEPS = 400


def _classes() -> np.ndarray:
    found = np.full(256, BEYOND, np.int64)
    found[:128] = ASCII
    for letter in range(26):
        found[[65 + letter, 97 + letter]] = 1 + letter
    found[48:58] = DIGIT
    for place, byte in enumerate(MARKS):
        found[byte] = 28 + place
    return found


CLASSES = _classes()


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The part after the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased, and the path after it."""
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    text = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(text, shape, 1), upper, upper.lower()), F.regexp_extract(text, shape, 2)


def matching_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest of ``rules`` (``host/path`` to verdict) that fits; null if none does."""
    found = []
    for rule in sorted(rules, key=lambda rule: (-len(rule), rule)):
        rule_host, slash, rest = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)
        found.append(F.when(fits, F.lit(rule)))
    return F.coalesce(*found, F.lit(None).cast("string"))


def grams(urls: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Codes of each character and end of each URL with its three predecessors, and where each URL's codes start."""
    data, marks = offsets_of(urls)
    count = len(marks) - 1
    lengths = np.diff(marks)
    owner = np.repeat(np.arange(count), lengths)
    padded = np.zeros(len(data) + (ORDER + 1) * count, np.int64)
    padded[np.arange(len(data)) + (ORDER + 1) * owner + ORDER] = CLASSES[data]
    codes = padded.copy()
    for back in range(1, ORDER + 1):
        codes[back:] += padded[:-back] * SYMBOLS**back
    begins = marks[:-1] + (ORDER + 1) * np.arange(count)
    inside = np.ones(len(padded), bool)
    for place in range(ORDER):
        inside[begins + place] = False
    return codes[inside], np.cumsum(lengths + 1) - (lengths + 1)


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    """Log probability of each character after each context of three, smoothed over the shorter contexts."""
    counts = counts.reshape((SYMBOLS,) * (ORDER + 1)).astype(np.float64)
    found = np.full(SYMBOLS, 1 / SYMBOLS)
    for order in range(ORDER + 1):
        own = counts.sum(axis=tuple(range(ORDER - order)))
        total, kinds = own.sum(axis=-1, keepdims=True), (own > 0).sum(axis=-1, keepdims=True)
        found = np.where(total > 0, (own + kinds * found) / np.maximum(total + kinds, 1), found)
    return np.log(found).reshape(-1)


def counted(urls: DataFrame) -> DataFrame:
    """How often each code occurs in the urls of each (accepted, held): columns accepted, held, code, times."""

    def work(piece: pa.RecordBatch) -> list:
        codes, begins = grams(piece.column(1))
        kinds = piece.column(0).to_numpy()
        lengths = np.diff(np.append(begins, len(codes)))
        keys, times = np.unique(np.repeat(kinds, lengths) * SYMBOLS ** (ORDER + 1) + codes, return_counts=True)
        return [pa.array(keys), pa.array(times)]

    kind = F.col("accepted").cast("long") * 2 + F.col("held").cast("long")
    found = map_texts(urls.select(kind.alias("kind"), "url"), ["kind", "url"], "key long, times long", work)
    return found.groupBy("key").agg(F.sum("times").alias("times"))


def means(urls: pa.Array, ratios: np.ndarray) -> np.ndarray:
    """The mean log ratio over the characters and the end of each URL."""
    codes, begins = grams(urls)
    sums = np.add.reduceat(ratios[codes].astype(np.float64), begins)
    return sums / np.diff(np.append(begins, len(codes)))


def scores(rows: DataFrame, ratios: np.ndarray, key: str, kind: str) -> DataFrame:
    """``key`` and the ``score`` of each row's ``url``."""
    sent = rows.sparkSession.sparkContext.broadcast(ratios.astype(np.float32))

    def work(piece: pa.RecordBatch) -> list:
        return [piece.column(0), pa.array(means(piece.column(1), sent.value))]

    return map_texts(rows, [key, "url"], f"{key} {kind}, score double", work)


def calibrated(ratios: np.ndarray, held: DataFrame) -> float:
    """The threshold with the best mean of both classes' shares of right verdicts on held-out urls; the middle one on ties."""
    span = float(np.abs(ratios).max()) or 1.0
    step = F.floor((F.col("score") + span) / (2 * span) * STEPS).cast("int")
    rows = scores(held, ratios, "accepted", "boolean").groupBy("accepted", step.alias("step")).count().collect()
    table = np.zeros((2, STEPS + 1))
    for row in rows:
        table[int(row["accepted"]), min(max(row["step"], 0), STEPS)] += row["count"]
    totals = table.sum(axis=1)
    if not totals.all():
        return 0.0
    # Below each edge: rejected urls that go rightly, and accepted ones that go wrongly.
    below = np.concatenate([np.zeros((2, 1)), np.cumsum(table, axis=1)[:, :-1]], axis=1) / totals[:, None]
    right = below[0] + 1 - below[1]
    best = np.flatnonzero(right == right.max())
    return float(best[len(best) // 2] / STEPS * 2 * span - span)


def verdicts(pages: DataFrame, rules: dict[str, str], key: str = "page_id", url: str = "url") -> DataFrame:
    """``key``, host, path, rule (null if none fits), score and verdict of each row."""
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(key).alias("key"), F.coalesce(F.col(url), F.lit("")).alias("url"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    ruled = F.lit(None).cast("string")
    for rule, verdict in rules.items():
        ruled = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(ruled)
    rows = rows.withColumn("ruled", ruled)
    known = rows.where("ruled is not null").select((F.col("ruled") == ALLOW).alias("accepted"), (F.crc32("url") % 5 == 0).alias("held"), "url")
    counts = np.zeros((2, 2, SYMBOLS ** (ORDER + 1)), np.int64)
    gathered = counted(known).toArrow()
    counts.reshape(-1)[gathered.column("key").to_numpy()] = gathered.column("times").to_numpy()
    kind = pages.schema[key].dataType.simpleString()
    if counts.sum(axis=(1, 2)).all():
        learnt = log_probabilities(counts[1, 0]) - log_probabilities(counts[0, 0])
        threshold = calibrated(learnt, known.where("held")) if counts[:, 0].sum(axis=1).all() else 0.0
        ratios = log_probabilities(counts[1].sum(axis=0)) - log_probabilities(counts[0].sum(axis=0))
    else:
        ratios, threshold = np.zeros(SYMBOLS ** (ORDER + 1)), -1.0
    sent = rows.sparkSession.sparkContext.broadcast(ratios.astype(np.float32))

    def work(piece: pa.RecordBatch) -> list:
        found = means(piece.column(5), sent.value)
        judged = np.where(found >= threshold, ALLOW, BLOCK)
        final = [a if a is not None else b for a, b in zip(piece.column(4).to_pylist(), judged.tolist(), strict=True)]
        return [piece.column(0), piece.column(1), piece.column(2), piece.column(3), pa.array(found), final]

    schema = f"{key} {kind}, host string, path string, rule string, score double, verdict string"
    return map_texts(rows, ["key", "host", "path", "rule", "ruled", "url"], schema, work)
