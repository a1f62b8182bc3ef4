import random
import re
from collections import Counter, defaultdict

import pyarrow as pa

from relata.llm import divergence
from relata.llm.catalog import ORACLES, op11_divergence
from tests.conftest import SMALL

SCHEMA = "lang string, source string, text string"


def plain(docs, min_docs=30, scale=10**9, smooth=5, top=50):
    """The report on (lang, source, text) by comparing every kept term of every pair."""
    groups, holders = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in docs:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)
        groups[lang or "", source or ""].update(words)
        holders[lang or ""].update(set(words))
    found = []
    for lang in {key[0] for key in groups}:
        kept = [term for term, held in holders[lang].items() if held >= min_docs]
        own = {source: counts for (name, source), counts in groups.items() if name == lang}
        own[None] = sum(own.values(), Counter())
        rates = {}
        for source, counts in own.items():
            total = sum(counts[t] for t in kept)
            rates[source] = {t: 1 + scale * (counts[t] + smooth) // (total + smooth * len(kept)) for t in kept}
        whole = rates.pop(None)
        for source, p in rates.items():
            parts = {
                "pair": [(sum(abs(p[t] - q[t]) for t in kept), other) for other, q in rates.items() if other != source],
                "term": [(p[t] - whole[t], t) for t in kept if own[source][t] and p[t] > whole[t]],
            }
            for part, rows in parts.items():
                rows.sort(key=lambda r: (-r[0], r[1].encode()))
                found += [(lang, source, part, item, value, i + 1) for i, (value, item) in enumerate(rows) if part == "pair" or i < top]
    return sorted(found)


def test_query(spark, duck):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("lang", "source", "text").collect()]
    found = sorted(map(tuple, op11_divergence(spark, SMALL).collect()))
    assert found == plain(docs)
    assert found == sorted(duck.execute(ORACLES["op11_divergence"]).fetchall())


def random_docs(rnd, count, sources, words):
    made = []
    for _ in range(count):
        source = "hot" if rnd.random() < 0.4 else f"s{rnd.randrange(sources)}"
        text = " ".join(rnd.choice(words) for _ in range(rnd.randrange(12)))
        made.append((rnd.choice(["en", "é", None]), source, text))
    return made


def test_random_sources(spark):
    rnd = random.Random(2)
    docs = random_docs(rnd, 400, 14, ["a", "B", "b", "cé", "d-d", "e5f", "😀x", "g", "h h", "Ü", "ü"])
    # A term that is everywhere as often as another has a row equal to its.
    docs += [(lang, f"s{i}", "twin1 twin2 twin3") for lang in ("en", "é") for i in range(14)]
    rnd.shuffle(docs)
    found = divergence.audit(spark.createDataFrame(docs, SCHEMA).repartition(4), min_docs=3, top=4)
    assert sorted(map(tuple, found.collect())) == plain(docs, min_docs=3, top=4)


def test_rows(spark):
    rows = [
        (None, None, None), ("", "", "Word word"), ("en", "a", "word WORD other 12"), ("en", "b", ""), ("en", "c", "word"), ("en", "c", "word"),
        ("fr", "only", "mot"), ("de", "x", "1 2"), ("de", "y", None), ("en", "d", "word " * 30_000),
    ]
    docs = spark.createDataFrame([(*row, 1, "t") for row in rows], SCHEMA + ", n int, term string")
    for least in (1, 2, 30):
        found = sorted(map(tuple, divergence.audit(docs, min_docs=least).collect()))
        assert found == plain(rows, min_docs=least)
    assert divergence.audit(docs.limit(0)).collect() == []


def test_rates_of_large_counts(spark):
    row = spark.sql("select 9000000000000 n, 9000000000007 total, 3 terms")
    found = row.select(divergence.rate("n", "total", "terms", divergence.SCALE, divergence.SMOOTH)).first()[0]
    assert found == 1 + 10**9 * (9 * 10**12 + 5) // (9 * 10**12 + 7 + 15)


def test_shared_paths_are_corrected_once():
    kind = pa.list_(pa.struct([("number", pa.int32()), ("p", pa.int64()), ("zero", pa.int64())]))
    item = lambda number, p: {"number": number, "p": p, "zero": number}
    paths = [[item(1, 9), item(2, 5), item(3, 8)], [item(1, 9), item(2, 5), item(4, 7)], [item(1, 9), item(3, 8)]]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["en"] * 4 + ["fr"]), pa.array([*paths, [item(2, 5), item(3, 8)], paths[0]], kind), pa.array([2, 1, 4, 1, 1], pa.int64())],
        names=["lang", "path", "held"],
    )
    parents, _, _, weights = divergence._trie(batch)
    # en: 1 > (2 > (3, 4), 3); 2 > 3; fr: 1 > 2 > 3.
    assert len(parents) == 10 and sorted(weights) == [1, 1, 1, 1, 1, 1, 2, 3, 4, 7]
    expected = Counter()
    for lang, path, held in zip(*batch.to_pydict().values(), strict=True):
        for i, x in enumerate(path):
            for y in path[i + 1 :]:
                change = abs(x["p"] - y["p"]) - abs(x["p"] - y["zero"]) - abs(x["zero"] - y["p"]) + abs(x["zero"] - y["zero"])
                expected[lang, x["number"], y["number"]] += held * change
    found = divergence.pair_corrections(batch)
    assert {tuple(row[:3]): row[3] for row in zip(*found.to_pydict().values(), strict=True)} == expected
    # A slice of the rows is a tree of its own.
    parts = Counter()
    for part in (batch.slice(0, 2), batch.slice(2, 3)):
        for row in zip(*divergence.pair_corrections(part).to_pydict().values(), strict=True):
            parts[tuple(row[:3])] += row[3]
    assert parts == expected
