import random
import re

import pyarrow as pa

from relata.llm import decontaminate, hashing
from relata.llm.catalog import ORACLES, op2_containment
from tests.conftest import SMALL


def shingles(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[a-z0-9\x80-\U0010ffff]+", folded)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain(docs, items):
    found = []
    for d, text in docs:
        held = shingles(text)
        for i, item in items:
            own = shingles(item)
            if own and len(own & held) >= len(own) * 4 / 5:
                found.append((d, i, len(own & held), len(own)))
    return sorted(found, key=str)


def test_query(spark, duck):
    found = sorted(map(tuple, op2_containment(spark, SMALL).collect()))
    assert found == sorted(duck.execute(ORACLES["op2_containment"]).fetchall())
    docs, items = ([tuple(r)[:2] for r in spark.read.parquet(f"{SMALL}/{name}.parquet").collect()] for name in ("documents", "benchmark"))
    assert sorted((r[:4] for r in found), key=str) == plain(docs, items)
    assert found


def test_random_texts(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 900)
    rnd = random.Random(8)

    def words(n):
        return [f"{rnd.choice('abcé')}{rnd.randrange(30)}" for _ in range(n)]

    items = [(i, " ".join(words(rnd.choice([1, 3, 5, 6, 9, 14, 15, 40])))) for i in range(40)]
    docs = []
    for d in range(120):
        text = words(rnd.randrange(30))
        for _ in range(rnd.randrange(3)):
            copy = rnd.choice(items)[1].split()
            for _ in range(rnd.randrange(3)):
                copy[rnd.randrange(len(copy))] = "changed"
            text += [x.upper() for x in copy] + words(rnd.randrange(20))
        docs.append((d, ", ".join(text)))
    docs += [(900 + i, item[1]) for i, item in enumerate(items[:8])]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = sorted((tuple(r)[:4] for r in decontaminate.search(*frames).collect()), key=str)
    assert found == plain(docs, items)
    held = {d for d, *_ in found}
    assert {r.doc_id for r in decontaminate.clean(*frames).collect()} == {d for d, _ in docs} - held


def test_rows(spark):
    item = "one two three four five six seven"
    docs = spark.createDataFrame(
        [(1, f"x {item.upper()}! y", 4), (1, f"x {item} y", 5), (None, item, 6), (2, None, 7), (3, "", 8), (4, "four five", 9)],
        "doc_id long, text string, item_id int",
    )
    items = spark.createDataFrame([(7, item), (8, item + "."), (9, None), (10, ""), (11, "Four, five")], "item_id long, text string")
    found = sorted((tuple(r) for r in decontaminate.search(docs, items).collect()), key=str)
    held = [(d, i, 3, 3, 1.0) for d in (1, 1, None) for i in (7, 8)] + [(4, 11, 1, 1, 1.0)]
    assert found == sorted(held, key=str)
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == [(2, None, 7), (3, "", 8)]
    assert decontaminate.search(docs.limit(0), items).collect() == []
    assert decontaminate.search(docs, items.limit(0)).collect() == []
    assert decontaminate.clean(docs, items.limit(0)).count() == 6


def test_stretches_do_not_change_hashes(monkeypatch):
    texts = pa.array(["ab cd", "", "ef " * 40 + "x" * 300, "é ab"])
    whole = decontaminate.Shingles(texts)
    monkeypatch.setattr(hashing, "STRETCH", 16)
    parts = decontaminate.Shingles(texts)
    assert whole.hashes.tolist() == parts.hashes.tolist() and whole.owner.tolist() == parts.owner.tolist()
    assert whole.words[0] == whole.words[-1]
