import hashlib
import itertools
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from relata.llm import pii
from relata.llm.catalog import op1_skip_chain
from tests.conftest import SMALL


def luhn(digits):
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        value = digit * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def plain(text):
    patterns = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda x: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda x: all(int(p) <= 255 for p in x.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda x: 16 <= len(re.sub("[^0-9]", "", x)) <= 19 and luhn(re.sub("[^0-9]", "", x))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda x: 8 <= len(re.sub("[^0-9]", "", x)) <= 15),
    }
    return [(k, *m.span()) for k, (kind, (pattern, check)) in enumerate(patterns.items()) for m in re.finditer(pattern, text) if check(m[0])]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["a", "b.c", "@", ".", "1", "23", "255", "300", "-", " ", "+", "(", ")", "é", "4111111111111111", "٣", "+1 (555) 123-4567", "\n", "x@y.z", "@@", "007"]), max_size=25))
def test_base_equals_the_patterns(parts):
    text = "".join(parts)
    assert pii.base_spans(text) == plain(text)


def test_long_texts_take_linear_work():
    for text in ("a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+1" + " " * 300_000, "a@" * 150_000, "4 " * 100_000):
        spans = pii.base_spans(text)
        pii.added_spans(text, spans, pii.fit([]))


def test_query(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = op1_skip_chain(spark, SMALL).collect()
    assert len(rows) == len(docs)
    for row in rows:
        base = plain(docs[row.doc_id])
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == kind for k, _, _ in base) for kind in range(4)]
        assert row.base_sha256 == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        held = [x for x in row.spans.split(",") if x]
        assert set(pii.joined(base).split(",")) - {""} <= set(held)
        assert len(held) == len(base) + row.n_added
    assert sum(r.n_added for r in rows) <= 0.05 * sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows)


def learnt():
    return pii.fit([pii.read_tokens(x, pii.base_spans(x)) for x in [f"Call +1 (4{n}6) 555-{n}99 or write u{n}@m.example.com from 10.0.{n}.7 word 4.0. {n}" for n in range(10, 90)]])


def test_adds_what_repeats_and_leaves_the_rest():
    field = learnt()
    text = "the (456) 555-2186 or +1 (456) 555-2186 in 2024, version 4.0. and 7 of 300.1.2.3"
    base = pii.base_spans(text)
    added = pii.added_spans(text, base, field)
    assert [text[a:b] for _, a, b in added] == ["(456) 555-2186"] and added[0][0] == 3
    assert pii.added_spans("plain words, version 4.0. of 1999", [], field) == []


def test_skip_edges_carry_labels():
    # Two equal tokens far apart: evidence at one of them makes the label of both.
    weights = np.zeros((pii.FEATURES, pii.LABELS))
    weights[pii.BIAS, 0] = 1
    weights[pii.BASE_START, 1] = 9
    field = pii.Field(weights, np.zeros((pii.LABELS, pii.LABELS)), 4 * np.eye(pii.LABELS))
    tokens = pii.read_tokens("abc1@x.de many words between them abc1@x.de", [(0, 0, 9)])
    assert tokens.skip == [(0, 1)] and tokens.chain == []
    alone = pii.Field(weights, field.chain, np.zeros((pii.LABELS, pii.LABELS)))
    assert field.beliefs(tokens)[1].argmax() == 1 and alone.beliefs(tokens)[1].argmax() == 0


def test_message_passing_is_exact_on_a_chain():
    random = np.random.default_rng(2)
    tokens = pii.read_tokens("1 22 333", [])
    field = pii.Field(random.normal(size=(pii.FEATURES, pii.LABELS)), random.normal(size=(pii.LABELS, pii.LABELS)), np.zeros((pii.LABELS, pii.LABELS)))
    scores = tokens.features @ field.weights
    beliefs = np.zeros_like(scores)
    for states in itertools.product(range(pii.LABELS), repeat=3):
        weight = np.exp(sum(scores[i, s] for i, s in enumerate(states)) + sum(field.chain[a, b] for a, b in itertools.pairwise(states)))
        for i, s in enumerate(states):
            beliefs[i, s] += weight
    assert np.allclose(field.beliefs(tokens), beliefs / beliefs.sum(axis=1, keepdims=True), atol=1e-4)


def test_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (1, "a@b.c", 2), (1, "a@b.c", 3), (None, "é a@b.c", 4)], "doc_id long, text string, n_email int")
    rows = sorted(((r.doc_id, r.n_email, r.spans) for r in pii.find(docs, pii.train(docs)).collect()), key=str)
    assert rows == [(1, 0, ""), (1, 1, "email:0:5"), (1, 1, "email:0:5"), (None, 1, "email:2:7")]
    assert pii.find(docs.limit(0), pii.train(docs.limit(0))).collect() == []


def test_evidence_reaches_all_of_a_hundred_equal_tokens():
    field = learnt()
    texts = ["or (456) 555-2186 in words between" for _ in range(100)]
    texts[3] = "or +1 (456) 555-2186 in words between"
    text = " ".join(texts)
    base = pii.base_spans(text)
    assert len(base) == 1
    assert [text[a:b] for _, a, b in pii.added_spans(text, base, field)] == ["(456) 555-2186"] * 99
    # Without any match, what stands beside one of them reaches the others alike, wherever it is.
    weights = np.zeros((pii.FEATURES, pii.LABELS))
    weights[pii.CUE_START + 3, 4] = 6
    field = pii.Field(weights, np.zeros((pii.LABELS, pii.LABELS)), 3 * np.eye(pii.LABELS))
    tokens = pii.read_tokens("call 5552186 " + "or 5552186 " * 99, [])
    beliefs = field.beliefs(tokens)
    assert (beliefs.argmax(axis=1) == 4).all() and np.allclose(beliefs[1], beliefs[-1], atol=1e-3)


def test_messages_settle_on_loops_with_strong_potentials():
    random = np.random.default_rng(5)
    tokens = pii.read_tokens(" ".join(random.choice(["12345", "67890", "24680", "x1234"], 200)), [])
    skip = random.normal(scale=5, size=(pii.LABELS, pii.LABELS))
    field = pii.Field(random.normal(size=(pii.FEATURES, pii.LABELS)), random.normal(scale=5, size=(pii.LABELS, pii.LABELS)), skip + skip.T)
    beliefs = field.beliefs(tokens)
    assert np.isfinite(beliefs).all() and np.allclose(beliefs.sum(axis=1), 1)
