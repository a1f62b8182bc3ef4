import hashlib
import random
import zlib
from itertools import groupby

from pyspark.sql import functions as F

from relata.llm import merkle
from relata.llm.catalog import ORACLES, op13_merkle
from tests.conftest import SMALL

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def above(nodes):
    """All levels over ``nodes``."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i : i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def path(levels, place):
    found = []
    for level in levels[:-1]:
        first = place // 3 * 3
        found.append(("".join(level[first:place]), "".join(level[place + 1 : first + 3])))
        place //= 3
    return found


def plain(rows):
    """(doc_id, leaf, subroot, root, proof digest, folded root, verified) of (doc_id, source, lang, n_chars, text)."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, (r[1] or "").encode(), r[0] is not None, r[0] or 0, plain_leaf(r)))
    trees = [list(group) for _, group in groupby(rows, key=lambda r: r[1])]
    levels = [above([plain_leaf(row) for row in tree]) for tree in trees]
    upper = above([tree[-1][0] for tree in levels])
    root, found = upper[-1][0], []
    for t, tree in enumerate(trees):
        for i, row in enumerate(tree):
            steps = path(levels[t], i) + path(upper, t)
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None
            value = plain_leaf(row[:4] + (row[4].replace("\n", ""),) if changed else row)
            for left, right in steps:
                value = h(left + value + right)
            proof = h("".join(left + right for left, right in steps))
            found.append((row[0], plain_leaf(row), levels[t][-1][0], root, proof, value, value == root))
    return found


def by_text(rows):
    return sorted(map(tuple, rows), key=str)


def test_query(spark, duck):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select(*merkle.FIELDS).collect()]
    found = by_text(op13_merkle(spark, SMALL).collect())
    assert found == by_text(plain(docs))
    assert found == by_text(duck.execute(ORACLES["op13_merkle"]).fetchall())
    assert {row[-1] for row in found} == {True, False}


def manifest(docs, levels):
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    fields = [F.translate("text", "\n", "") if name == "text" else F.col(name) for name in merkle.FIELDS]
    out = merkle.manifest(docs, F.when(changed, merkle.leaf(*fields)), levels=levels)
    return by_text(out.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(), "folded_root", "verified").collect())


def test_many_superblocks_and_one_hot_source(spark):
    rnd = random.Random(6)
    rows = [(i, "hot", "en", i, f"line {i}\nend") for i in range(100)]
    rows += [(1000 + i, f"s{i}", None, None, "x" * rnd.randrange(4)) for i in range(29)]
    rnd.shuffle(rows)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert manifest(docs, 1) == by_text(plain(rows))
    assert manifest(docs, 2) == by_text(plain(rows))


def test_rows(spark):
    rows = [
        (1, None, None, None, None), (2, "", "", 0, ""), (None, None, "de", 3, "äöü\n😀"), (7, "é", "fr", 2, "\n\n"), (7, "é", "fr", 2, "\n\n"),
        (7, "é", "fr", 3, "other"), (-5, "z", "en", 1, "a"), (2**60 + 1, None, "en", 9, "long " * 50_000),
    ]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("tree", F.lit("x")).withColumn("root", F.lit(None))
    assert manifest(docs, merkle.LEVELS) == by_text(plain(rows))
    assert manifest(docs.limit(0), merkle.LEVELS) == []
    alone = rows[6:7]
    assert manifest(spark.createDataFrame(alone, SCHEMA), merkle.LEVELS) == by_text(plain(alone))
    # Without a copy to check, every row leads to the root.
    assert all(r.verified for r in merkle.manifest(docs).collect())


def test_a_proof_fails_where_anything_changed():
    levels = above([h(str(i)) for i in range(50)])
    found = merkle.reduce(levels[0], 50, 9)
    assert found == levels
    lefts, rights = merkle.beside(found)
    assert all(merkle.fold(levels[0][i], lefts[i], rights[i]) == levels[-1][0] for i in range(50))
    assert merkle.fold(h("other"), lefts[3], rights[3]) != levels[-1][0]
    assert merkle.fold(levels[0][3], rights[3], lefts[3]) != levels[-1][0]
