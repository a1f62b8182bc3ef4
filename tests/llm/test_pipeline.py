"""The pipeline against the brute-force versions of its stages, one after the other."""

import pyarrow as pa

import corpus_pipeline
from relata.llm import nbsvm
from tests.conftest import SMALL
from tests.llm.test_bpe import theirs
from tests.llm.test_decontaminate import plain as plain_search
from tests.llm.test_line_dedup import plain as plain_dedup
from tests.llm.test_simhash import plain_groups, plain_print


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "bpe_encoding",
    ]
    assert corpus_pipeline.ORACLE_SQL is None


def test_run(spark):
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    model = nbsvm.train(frame, spark.read.parquet(f"{SMALL}/labels.parquet"))
    docs = sorted((r.doc_id, r.text) for r in frame.collect())
    scores = model.scores(nbsvm.indicators(pa.array([text for _, text in docs])))
    docs = [row for row, score in zip(docs, scores, strict=True) if score >= nbsvm.THRESHOLD]
    docs = [(key, text) for (key, _), (text, _, gone) in zip(docs, plain_dedup(docs), strict=True) if not gone or text.strip(" \t\n\x0b\x0c\r")]
    groups = plain_groups([key for key, _ in docs], [plain_print(text) for _, text in docs])
    docs = [row for row, head in zip(docs, groups, strict=True) if row[0] == head]
    leaked = {key for key, *_ in plain_search(docs, items)}
    docs = [row for row in docs if row[0] not in leaked]
    found = sorted(map(tuple, corpus_pipeline.run(spark, SMALL).collect()))
    assert found == [(key, len(theirs(text)), theirs(text)) for key, text in docs]


def test_stage_columns_and_empty_tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SMALL)
        assert after.collect() == []
        if name != "bpe_encoding":
            assert after.columns == docs.columns
            docs = after
