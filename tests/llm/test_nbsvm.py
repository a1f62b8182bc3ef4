import zlib

import numpy as np
import pyarrow as pa

from relata.llm import nbsvm
from relata.llm.catalog import op7_nbsvm
from tests.conftest import SMALL


def held(key):
    return zlib.crc32(str(key).encode()) % 5 == 0


def test_query_on_held_out_labels(spark):
    folder = SMALL.replace("0.001", "0.01")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = op7_nbsvm(spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([a == b for a, b in judged]) > 0.95


def test_held_out_labels_are_not_learnt(spark):
    docs = spark.createDataFrame([(i, ("good words " if i % 2 else "BAD!! STUFF!! ") * 9) for i in range(80)], "doc_id long, text string")
    true = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, quality int")
    mixed = spark.createDataFrame([(i, 1 - i % 2 if held(i) else i % 2) for i in range(80)], "doc_id long, quality int")
    scores = [sorted(map(tuple, nbsvm.score(docs, nbsvm.train(docs, labels)).collect())) for labels in (true, mixed)]
    assert scores[0] == scores[1]
    assert all((score >= 0.3) == bool(key % 2) for key, score in scores[0])
    kept = nbsvm.keep(docs, nbsvm.train(docs, true))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(1, 80, 2))


def test_indicators_do_not_depend_on_the_piece():
    texts = ["One two  two.", "", "é\x00x", "abc" * 99, "One two  two."]
    together = nbsvm.indicators(pa.array(texts))
    for text, row in zip(texts, together, strict=True):
        assert nbsvm.indicators(pa.array([text]))[0].tolist() == row.tolist()
    assert not len(together[1])


def test_rows(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (1, "a b", 0.5), (None, "", 0.1), (2, "x " * 50_000, 0.2)], "doc_id long, text string, score double")
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert sorted(r.score for r in nbsvm.score(docs, nbsvm.train(docs, empty)).collect()) == [0.5] * 4
    one = spark.createDataFrame([(1, 1), (1, None), (2, 1), (None, 0)], "doc_id long, quality int")
    assert all(r.score > 0.5 for r in nbsvm.score(docs, nbsvm.train(docs, one)).collect())
    assert nbsvm.keep(docs, nbsvm.train(docs, one)).columns == docs.columns
    assert nbsvm.score(docs.limit(0), nbsvm.train(docs.limit(0), one)).collect() == []
