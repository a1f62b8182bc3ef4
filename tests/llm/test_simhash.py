import random
import re

import numpy as np
import xxhash

from relata.llm import simhash
from relata.llm.catalog import op5_simhash
from relata.llm.components import components
from tests.conftest import SMALL


def plain_print(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_groups(ids, prints):
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    values = np.array(prints, np.uint64)
    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(values[:i] ^ values[i]) <= 3):
            parent[root(i)] = root(int(j))
    least = {}
    for i, key in enumerate(ids):
        least[root(i)] = min(least.get(root(i), key), key)
    return [least[root(i)] for i in range(len(ids))]


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    ids, prints = [r.doc_id for r in docs], [plain_print(r.text) for r in docs]
    expected = sorted((i, f"{p:016x}", c) for i, p, c in zip(ids, prints, plain_groups(ids, prints), strict=True))
    assert sorted(map(tuple, op5_simhash(spark, SMALL).collect())) == expected


def units(spark, values):
    return spark.createDataFrame([(int(v - (1 << 64) if v >> 63 else v),) for v in values], "print long")


def test_links_connect_all_near_pairs_and_no_others(spark, monkeypatch):
    rnd = random.Random(5)
    values = set()
    for _ in range(12):
        center = rnd.getrandbits(64)
        for _ in range(60):
            value = center
            for _ in range(rnd.randint(0, 5)):
                value ^= 1 << rnd.randrange(64)
            values.add(value)
    values |= {rnd.getrandbits(64) for _ in range(300)}
    values = sorted(values)
    monkeypatch.setattr(simhash, "BLOCK", 16)
    edges = [(a % (1 << 64), b % (1 << 64)) for a, b in simhash.near_links(units(spark, values)).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in edges)
    place = {v: i for i, v in enumerate(values)}
    expected = plain_groups(list(range(len(values))), values)
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        x, y = sorted((root(place[a]), root(place[b])))
        parent[y] = x
    assert [root(i) for i in range(len(values))] == expected


def test_no_pair_list_in_a_group_of_near_copies(spark):
    values = [i for i in range(1 << 12) if i.bit_count() <= 3]
    assert simhash.near_links(units(spark, values)).count() < 8 * len(values)


def test_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(120)], "a long, b long")
    found = components(edges).collect()
    assert {r.root for r in found} == {0} and len(found) == 120


def test_rows(spark):
    docs = spark.createDataFrame(
        [(4, "One two  three four", 1), (2, "one two three\nfour", 2), (2, "one two three\nfour", 3), (None, "other words are here", 4), (9, None, 5), (7, " \n", 6), (8, "a b", 7)],
        "doc_id long, text string, component_id long",
    )
    found = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert {(4, f"{plain_print('one two three four'):016x}", 2), (9, "0" * 16, 7), (7, "0" * 16, 7), (8, f"{plain_print('a b'):016x}", 8)} <= found
    assert any(key is None and group is None for key, _, group in found)
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2, 7, 8]
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_one_row_stays_of_each_component_with_null_and_repeated_ids(spark):
    rnd = random.Random(8)
    texts = [" ".join(f"w{rnd.randrange(10**6)}" for _ in range(300)) for _ in range(12)]
    near = lambda text: text + " " + text.split()[-1]
    assert all((plain_print(text) ^ plain_print(near(text))).bit_count() <= 3 for text in texts)
    # Null ids in components of their own; two clean texts under one id; under id 3 the head of a group and a copy of id 1.
    rows = [(None, text, n) for n, text in enumerate(texts[:5])] + [(None, near(texts[0]), 5), (7, texts[5], 6), (7, texts[6], 7)]
    rows += [(1, texts[7], 8), (3, texts[8], 9), (3, near(texts[7]), 10), (4, near(texts[8]), 11), (None, near(texts[9]), 12), (9, texts[9], 13)]
    rows += [(7, texts[5], 14)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    groups = plain_groups(list(range(len(rows))), [plain_print(text) for _, text, _ in rows])
    found = [sorted(map(tuple, simhash.one_per_group(docs.repartition(parts, "n")).collect()), key=str) for parts in (1, 2, 5)]
    assert found[0] == found[1] == found[2]
    assert sorted(groups[n] for _, _, n in found[0]) == sorted(set(groups))
    assert {n for _, _, n in found[0]} >= {1, 2, 3, 4, 7, 8, 9, 13}
