import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from relata.llm import bpe
from relata.llm.catalog import op10_bpe, tokenizer_file
from tests.conftest import SMALL

tokenizers = pytest.importorskip("tokenizers")
PATH = tokenizer_file()
THEIRS = tokenizers.Tokenizer.from_file(PATH)


def theirs(text):
    return THEIRS.encode(text, add_special_tokens=False).ids


def ours(text):
    return np.frombuffer(bpe.encode_texts(PATH, [text])[0], "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*" \n\t'aeiouthnsrdTHE.,!0129éß日²\x1c ", "<|endoftext|>", "the", "==", "'ll", "tion"]), max_size=40))
def test_equals_the_library(parts):
    text = "".join(parts)
    assert ours(text) == theirs(text)
    assert bpe.decode_ids(PATH, np.array(ours(text), "<u4")) == THEIRS.decode(theirs(text), skip_special_tokens=False)


def test_plain_and_general_patterns_agree_on_every_plain_character():
    import re

    import regex

    odd = re.compile(bpe.ODD_PATTERN)
    text = "".join(f"a{c}1 {c}{c}." for c in map(chr, range(0x2B0)) if not odd.search(c))
    assert re.findall(bpe.PLAIN_PATTERN, text) == regex.findall(bpe.WORD_PATTERN, text)


def test_every_token_is_its_own_encoding():
    vocab = bpe.vocabulary(PATH)
    for token in list(vocab.id_of.values())[::97]:
        left, *_ = vocab.parts.get(token, (None,))
        assert left is None or vocab.compatible(*vocab.parts[token][1:]) is False


def test_very_long_word():
    text = "abcdefghij" * 20_000
    assert ours(text) == theirs(text)


def test_rows(spark):
    docs = spark.createDataFrame(
        [(1, "the cat", "x"), (1, "the cat", "y"), (None, "", "z"), (2, None, None), (3, "a<|endoftext|>b", "z")],
        "doc_id long, text string, token_ids string",
    )
    encoded = bpe.encode(docs, PATH)
    assert encoded.columns == ["doc_id", "n_tokens", "token_ids"]
    found = sorted(((r.doc_id or 0, r.n_tokens, r.token_ids) for r in encoded.collect()))
    assert found == [(0, 0, []), (1, 2, theirs("the cat")), (1, 2, theirs("the cat")), (2, 0, []), (3, 3, theirs("a<|endoftext|>b"))]
    assert sorted(r.text for r in bpe.decode(encoded, PATH).collect()) == ["", "", "a<|endoftext|>b", "the cat", "the cat"]
    assert bpe.encode(docs.limit(0), PATH).collect() == []


def test_query(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = op10_bpe(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = theirs(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()
