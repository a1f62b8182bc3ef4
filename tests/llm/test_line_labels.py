import itertools
import re

import numpy as np
import pyarrow as pa

from relata.llm import line_labels
from relata.llm.catalog import op3_line_field
from tests.conftest import SMALL


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen, same = text.split("\n"), set(), 0
    for line in lines:
        same += bool(re.search(r"[^\x20\x09-\x0D]", line)) and line in seen
        seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {i + k for i, w in enumerate(windows) for k in range(3) if windows.count(w) > 1} if len(windows) < 400 else None
    if often is None:
        from collections import Counter

        times = Counter(windows)
        often = {i + k for i, w in enumerate(windows) for k in range(3) if times[w] > 1}
    failed = len(words) < 50 or 100 * len(often) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), same, len(often), failed


def test_query(spark):
    folder = SMALL.replace("0.001", "0.01")
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = op3_line_field(spark, folder).collect()
    assert len(rows) == len(docs)
    good, bad = [], []
    for row in rows:
        assert tuple(row)[1:7] == plain(docs[row.doc_id])
        assert not (row.base_failed and row.kept)
        if row.doc_id in labels and not row.base_failed:
            (good if labels[row.doc_id] else bad).append(row.kept)
    assert np.mean(good) == 1 and np.mean(bad) < 0.1


def test_counts_of_odd_texts():
    texts = ["", "\x00 a\x00", " \n\n", "é é é é é", "a b c a b c\na b c\r\na b c", "<#>|\n<#>|\n <#>|", "x" * 200_000, "a\x1cb"]
    found = line_labels.count(pa.array(texts))
    rows = zip(found.words, found.characters, found.symbols, found.same_lines, found.repeated_words, strict=True)
    assert [tuple(map(int, row)) for row in rows] == [plain(text)[:5] for text in texts]


def test_viterbi_and_likelihood():
    random = np.random.default_rng(1)
    owner = np.repeat([0, 2, 3], [5, 1, 7])
    features = random.integers(0, line_labels.FEATURES, (13, 3))
    field = line_labels.Field(random.normal(size=(line_labels.FEATURES, 2)), random.normal(size=(2, 2)))
    marks = field.marks(features, owner)
    for text in np.unique(owner):
        own = np.flatnonzero(owner == text)
        scores = field.weights[features[own]].sum(axis=1)

        def total(states, scores=scores):
            return sum(scores[i, s] for i, s in enumerate(states)) + sum(field.steps[a, b] for a, b in itertools.pairwise(states))

        assert tuple(marks[own]) == max(itertools.product((0, 1), repeat=len(own)), key=total)


def test_fit_uses_neighbours():
    # State 1 comes in runs; a line of feature 2 tells nothing, its neighbours do.
    owner = np.repeat(np.arange(40), 5)
    states = np.repeat(np.arange(40) % 2, 5)
    features = states.reshape(-1, 1).copy()
    features[2::5] = 2
    field = line_labels.fit(features, owner, states)
    assert (field.marks(features, owner) == states).all()


def test_rows(spark):
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, None, True), (1, text, True), (1, text, False), (None, "a\n" * 70, None)], "doc_id long, text string, kept boolean")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    rows = sorted(map(tuple, line_labels.judge(docs, line_labels.train(docs, labels)).collect()), key=str)
    assert rows == sorted([(1, 0, 0, 0, 0, 0, True, None, False)] + [(1, 60, 170, 0, 0, 0, False, 1.0, True)] * 2 + [(None, 70, 70, 0, 69, 70, True, 1.0, False)], key=str)
    assert line_labels.judge(docs.limit(0), line_labels.train(docs, labels)).collect() == []
