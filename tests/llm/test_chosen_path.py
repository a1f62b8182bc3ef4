import random
import re

import numpy as np
import pyarrow as pa

from relata.llm import chosen_path
from relata.llm.catalog import ORACLES, op12_chosen_path
from relata.llm.frames import stored
from tests.conftest import SMALL


def shingles(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain(rows):
    """(doc_id, set size, component, kept) of (doc_id, text) by comparing all pairs."""
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, own in enumerate(sets):
        for j in range(i):
            if own and 100 * len(own & sets[j]) >= 85 * len(own | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(least.get(root(i), key), key)
    return [(key, len(sets[i]), least.get(root(i)), least.get(root(i)) == key) for i, (key, _) in enumerate(rows)]


def by_text(rows):
    return sorted(map(tuple, rows), key=str)


def near_texts(rnd, clusters, size, most):
    texts = []
    for _ in range(clusters):
        center = [f"w{rnd.randrange(5000)}" for _ in range(rnd.choice([40, 120, 300]))]
        for _ in range(size):
            words = list(center)
            for _ in range(rnd.randint(0, most)):
                words[rnd.randrange(len(words))] = f"x{rnd.randrange(10**6)}"
            texts.append(" ".join(words))
    return texts


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_query(spark, duck):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    found = by_text(op12_chosen_path(spark, SMALL).collect())
    assert found == by_text(plain(docs)) == by_text(duck.execute(ORACLES["op12_chosen_path"]).fetchall())
    assert not all(row[3] for row in found)


def test_near_copies_around_the_threshold(spark, monkeypatch):
    monkeypatch.setattr(chosen_path, "BLOCK_SHINGLES", 900)
    rnd = random.Random(9)
    rows = list(enumerate(near_texts(rnd, 12, 20, 5)))
    rnd.shuffle(rows)
    found = by_text(chosen_path.near_copies(frame(spark, rows)).collect())
    assert found == by_text(plain(rows))
    assert 12 < len({row[2] for row in found}) < len(rows)


def units(spark, texts):
    piece = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(range(len(texts))), pa.array(texts)], names=["key", "text_key", "text"])
    columns = [column.to_pylist() for column in chosen_path._described(piece)]
    rows = [(i, columns[2][i], columns[5][i], bytearray(columns[6][i])) for i in range(len(texts))]
    return spark.createDataFrame(rows, "unit long, n long, tokens array<long>, sketch binary")


def test_large_nodes_branch_and_are_dealt_into_blocks(spark):
    rnd = random.Random(10)
    passage = " ".join(f"p{i}" for i in range(40))
    # Near copies stay together at every branching; texts that share a passage only are drawn apart.
    texts = list(dict.fromkeys(near_texts(rnd, 1, 60, 2))) + [f"{passage} " + " ".join(f"y{rnd.randrange(10**6)}" for _ in range(60)) for _ in range(80)]
    sets = [shingles(text) for text in texts]
    for depth in (0, 2):
        edges = chosen_path.candidates(units(spark, texts), node=16, depth=depth, block=16).collect()
        parent = list(range(len(texts)))

        def root(i, parent=parent):
            while parent[i] != i:
                i = parent[i]
            return i

        for a, b in edges:
            parent[root(a)] = root(b)
        for i, own in enumerate(sets):
            for j in range(i):
                if 100 * len(own & sets[j]) >= 85 * len(own | sets[j]):
                    assert root(i) == root(j)
        # No text with another rest is a candidate, and no list of all pairs is made.
        last = len(texts) - 80
        assert {root(i) for i in range(last, len(texts))} == set(range(last, len(texts)))
        assert len(edges) < 8 * 2**depth * 3 * last


def test_sketches_move_once_a_unit_at_any_size(spark):
    rnd = random.Random(11)
    described = stored(units(spark, near_texts(rnd, 10, 8, 2)), "described")
    name, plans, joined = "spark.sql.autoBroadcastJoinThreshold", [], []
    usual = spark.conf.get(name)
    for most in ("-1", "1g"):
        spark.conf.set(name, most)
        try:
            found = chosen_path.candidates(described)
            plan = found._jdf.queryExecution().executedPlan().toString()
            joined.append({unit for edge in found.collect() for unit in edge})
        finally:
            spark.conf.set(name, usual)
        plans.append(sorted(re.sub(r"#\d+L?", "", keys) for keys in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)))
    # Members (without sketches) and sketches meet by unit, then what meets in a node goes there: nothing else is shuffled.
    assert plans == [["node, pair", "unit", "unit"]] * 2
    assert joined[0] and joined[0] == joined[1]


def test_rows(spark):
    rows = [
        (4, "One two three four five six"), (2, "one TWO three\nfour five  six"), (2, "one two three four five six"), (None, "other words"),
        (9, None), (7, " \n"), (8, "a b"), (3, "A B"), (None, "nothing like it is here at all"), (None, "a b"), (6, "a\x00b c"), (5, "b a"),
        (1, "x " * 60_000), (12, "x " * 3), (11, "x " * 70_000),
    ]
    docs = frame(spark, rows).selectExpr("*", "1 as n", "'z' as unit", "array(1) as tokens", "doc_id as component_id")
    found = chosen_path.near_copies(docs)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert by_text(found.collect()) == by_text(plain(rows))
    assert chosen_path.near_copies(docs.limit(0)).collect() == []


def test_sets_are_exact():
    texts = ["a b c d e f a b c d e f", "", "A b", "a b", "b a", "é è ê ë e x", None, "a b c d e"]
    hashes, bounds = chosen_path.sets_of(pa.array([text or "" for text in texts]))
    found = [set(hashes[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert [len(x) for x in found] == [len(shingles(text)) for text in texts]
    assert found[2] == found[3] != found[4] and found[7] < found[0]


def test_forests_of_exact_links():
    rnd = random.Random(1)
    sets = [np.array(sorted(rnd.sample(range(120), rnd.randint(90, 110))), np.uint64) for _ in range(60)]
    joined = {frozenset(edge) for edge in chosen_path.confirmed(sets)}
    held = [set(x.tolist()) for x in sets]
    linked = lambda i, j: 100 * len(held[i] & held[j]) >= 85 * len(held[i] | held[j])
    assert all(linked(*edge) for edge in joined)
    parent = list(range(60))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in joined:
        parent[root(i)] = root(j)
    assert all(root(i) == root(j) for i in range(60) for j in range(i) if linked(i, j))
