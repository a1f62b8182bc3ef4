import random

from relata.llm import reply_trees
from relata.llm.catalog import ORACLES, op8_reply_trees
from tests.conftest import SMALL

SCHEMA = "tree long, node long, parent long, role string, text string, score double"


def test_query(spark, duck):
    out = op8_reply_trees(spark, SMALL)
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    assert out.columns == names
    found = sorted(map(tuple, out.collect()))
    assert found == sorted(duck.execute(f"select {', '.join(names)} from ({ORACLES['op8_reply_trees']})").fetchall())
    assert found[0][:2] == (-7, 2) and found[0][3] == len("</s>[INST] ok [/INST]")


def plain_branches(rows, best):
    by_tree = {}
    for tree, node, parent, role, text, score in rows:
        by_tree.setdefault(tree, {})[node] = (parent, role, text, score)
    found = []
    for tree, nodes in by_tree.items():
        leaves = []
        for node in nodes.keys() - {row[0] for row in nodes.values()}:
            path = [node]
            while nodes[path[-1]][0] in nodes:
                path.append(nodes[path[-1]][0])
            leaves.append((-sum(nodes[n][3] for n in path), -len(path), node, path[::-1]))
        for rank, (_, _, leaf, path) in enumerate(sorted(leaves)[:best], 1):
            found += [(tree, rank, leaf, place, node, *nodes[node][1:3]) for place, node in enumerate(path, 1)]
    return sorted(found)


def test_random_trees(spark):
    rnd = random.Random(4)
    rows = []
    for tree in range(9):
        for node in range(1, rnd.randrange(2, 40)):
            parent = rnd.choice([None, 999, *range(1, node)][-4:]) if node > 1 else None
            rows.append((tree, node, parent, rnd.choice(["user", "assistant"]), f"t{node}", float(rnd.randrange(-3, 4))))
    found = reply_trees.branches(spark.createDataFrame(rows, SCHEMA), best=2)
    assert sorted(map(tuple, found.collect())) == plain_branches(rows, 2)


def test_spans_and_escapes(spark):
    texts = ["a&lt;b [INST] </s>", "", "&amp;amp;[", "é</s></s>"]
    rows = [(1, i, i - 1 if i else None, "assistant" if i % 2 else "us<er", text, 0.0) for i, text in enumerate(texts)]
    written = reply_trees.conversations(reply_trees.branches(spark.createDataFrame(rows, SCHEMA)))
    (row,) = written.collect()
    assert row.formatted.count("</s>") == row.formatted.count("[INST]") == 4
    held = [row.formatted[span.start : span.end] for span in row.loss_spans]
    assert held == ["", "é&lt;/s>&lt;/s>"]
    back = sorted(map(tuple, reply_trees.read_back(written, "tree").collect()))
    assert back == [(1, i, "assistant" if i % 2 else "us<er", text, bool(i % 2)) for i, text in enumerate(texts)]


def test_rows(spark):
    rows = [
        (None, 1, None, "user", "x", None), (None, 1, None, "user", "x", None), (None, 2, 1, None, None, 1.0),
        (5, 1, 2, "user", "circle", 1.0), (5, 2, 1, "user", "circle", 1.0), (5, 3, 2, "user", "below", 1.0), (6, None, None, "user", "x", 1.0),
    ]
    trees = spark.createDataFrame([(*row, 9) for row in rows], SCHEMA + ", its long")
    assert sorted(map(tuple, reply_trees.branches(trees).collect())) == [(None, 1, 2, 1, 1, "user", "x"), (None, 1, 2, 2, 2, "", "")]
    assert reply_trees.digests(reply_trees.conversations(reply_trees.branches(trees)), "tree").first().n_turns == 2
    assert reply_trees.branches(trees.limit(0)).collect() == []
    flat = spark.createDataFrame([(1, 2, "b", "same"), (1, 2, "b", "same"), (1, None, "a", None)], "conv_id long, turn long, role string, text string")
    assert [r.parent for r in reply_trees.chain(flat).orderBy("node").collect()] == [None, 1, 2]


def test_no_python_in_the_plan(spark):
    plan = op8_reply_trees(spark, SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
