import random
import re

from relata.llm import line_dedup
from relata.llm.catalog import op9_winnowing
from tests.conftest import SMALL

MOST = line_dedup.MIN_WORDS
WHITE = " \t\n\x0b\x0c\r"


def removed(docs):
    """For each document, the lines in runs of enough words that occur at any earlier place. ``docs``: lists of lines."""
    held = [(d, at) for d, doc in enumerate(docs) for at in range(len(doc))]
    gone, earlier = [set() for _ in docs], {}
    for d, at in held:
        places = earlier.setdefault(docs[d][at], [])
        for e, begin in places:
            size, words = 0, 0
            while at + size < len(docs[d]) and begin + size < len(docs[e]) and docs[d][at + size] == docs[e][begin + size]:
                words += len(re.split(r"[\x20\x09-\x0D]+", docs[d][at + size]))
                size += 1
            if words >= MOST:
                gone[d] |= set(range(at, at + size))
        places.append((d, at))
    return gone


def plain(docs):
    """New texts by comparing every run of lines with all earlier places. ``docs``: (id, text), ids in order."""
    cut = [(text or "").split("\n") for _, text in docs]
    places = [[i for i, x in enumerate(pieces) if x.strip(WHITE)] for pieces in cut]
    held = [[pieces[i].strip(WHITE) for i in own] for pieces, own in zip(cut, places, strict=True)]
    found = []
    for (_, text), pieces, own, gone in zip(docs, cut, places, removed(held), strict=True):
        left = {own[i] for i in gone} | {j for i in gone if i + 1 in gone for j in range(own[i], own[i + 1])}
        found.append(("\n".join(x for i, x in enumerate(pieces) if i not in left) if gone else text, len(own), len(gone)))
    return found


def test_query(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    found = sorted((r.doc_id, r.text, r.n_lines, r.n_removed) for r in op9_winnowing(spark, SMALL).collect())
    expected = [(key, *rest) for (key, _), rest in zip(docs, plain(docs), strict=True)]
    assert found == expected
    assert sum(r[3] for r in found) > 0


def test_random_runs(spark):
    rnd = random.Random(3)
    stock = [" ".join(f"w{rnd.randrange(9)}" for _ in range(rnd.choice([1, 3, 9, 20, 49, 50, 60]))) for _ in range(14)]
    docs = []
    for key in range(60):
        chosen = []
        while len(chosen) < rnd.randrange(25):
            at = rnd.randrange(len(stock))
            chosen += stock[at : at + rnd.randrange(6)] if rnd.random() < 0.8 else ["", f" fresh {key} {len(chosen)} "]
        docs.append((key, "\n".join(chosen)))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    found = sorted(map(tuple, line_dedup.remove_repeats(frame).collect()))
    assert found == [(key, *rest) for (key, _), rest in zip(docs, plain(docs), strict=True)]


def test_rows(spark):
    long = " ".join(f"word{i}" for i in range(60))
    rows = [
        (1, long, 5, "a"), (1, long, 5, "a"), (2, f"x\n \t{long}\r\ny", 6, "b"), (None, long, 7, "c"), (3, None, 8, "d"), (4, "", 9, "e"),
        (5, "short\nshort", 11, "f"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, late string").withColumnRenamed("late", "runs")
    out = line_dedup.remove_repeats(docs)
    assert out.columns == ["doc_id", "text", "n_chars", "runs", "n_lines", "n_removed"]
    found = sorted(map(tuple, out.collect()), key=lambda r: (r[0] or 99, r[3]))
    assert found == [
        (1, long, 5, "a", 1, 0), (1, long, 5, "a", 1, 0), (2, "x\ny", 3, "b", 3, 1), (3, None, 8, "d", 0, 0), (4, "", 9, "e", 0, 0),
        (5, "short\nshort", 11, "f", 2, 0), (None, "", 0, "c", 1, 1),
    ]
    assert line_dedup.remove_repeats(docs.limit(0)).collect() == []


def rest_of(spark, docs):
    frame = spark.createDataFrame([(key, "\n".join(doc)) for key, doc in enumerate(docs)], "doc_id long, text string")
    return [r.text for r in line_dedup.remove_repeats(frame.repartition(3)).orderBy("doc_id").collect()]


def test_runs_that_go_on_differently_where_they_occur_first(spark):
    a, b, c = (" ".join(f"{name}{i}" for i in range(size)) for name, size in (("a", 45), ("b", 5), ("c", 44)))
    assert rest_of(spark, [[a, b, "x"], [a, b, c, "y"], [a, b, c, "z"]]) == [f"{a}\n{b}\nx", f"{c}\ny", "z"]
    rnd = random.Random(4)
    stock = [" ".join(f"w{rnd.randrange(9)}" for _ in range(rnd.choice([1, 3, 9, 20, 44, 49, 50, 60]))) for _ in range(12)]
    docs = []
    for key in range(40):
        chosen = []
        while len(chosen) < rnd.randrange(20):
            at = rnd.randrange(len(stock))
            chosen += stock[at : at + rnd.randrange(6)] if rnd.random() < 0.8 else [f"fresh {key} {len(chosen)}"]
        docs.append(chosen)
    expected = ["\n".join(x for i, x in enumerate(doc) if i not in gone) for doc, gone in zip(docs, removed(docs), strict=True)]
    assert rest_of(spark, docs) == expected
