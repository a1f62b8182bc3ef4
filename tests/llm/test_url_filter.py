import math
import re
import zlib
from collections import Counter

import pytest

from relata.llm import url_filter
from relata.llm.catalog import URL_RULES, op4_url_ratio
from tests.conftest import SMALL


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def fitting(host, path):
    found = [r for r in URL_RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/") :])]
    return max(found, key=len, default=None)


class PlainModel:
    def __init__(self, urls):
        self.counts = [Counter() for _ in range(4)]
        for url in urls:
            symbols = [0, 0, 0, *(int(url_filter.CLASSES[b]) for b in url.encode()), 0]
            for at in range(3, len(symbols)):
                for order in range(4):
                    self.counts[order][tuple(symbols[at - order : at + 1])] += 1

    def probability(self, context, symbol):
        found = 1 / url_filter.SYMBOLS
        for order in range(4):
            last = tuple(context[3 - order :])
            own = [self.counts[order][(*last, s)] for s in range(url_filter.SYMBOLS)]
            if sum(own):
                kinds = sum(n > 0 for n in own)
                found = (own[symbol] + kinds * found) / (sum(own) + kinds)
        return found

    def log(self, url):
        symbols = [0, 0, 0, *(int(url_filter.CLASSES[b]) for b in url.encode()), 0]
        return sum(math.log(self.probability(symbols[at - 3 : at], symbols[at])) for at in range(3, len(symbols)))


def test_query(spark):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url").collect()}
    rows = op4_url_ratio(spark, SMALL).collect()
    assert sorted(r.page_id for r in rows) == sorted(urls)
    rule = {key: fitting(*parts(url)) for key, url in urls.items()}
    accepted = PlainModel([urls[key] for key in urls if rule[key] and URL_RULES[rule[key]] == "allow"])
    rejected = PlainModel([urls[key] for key in urls if rule[key] and URL_RULES[rule[key]] == "block"])
    judged = {"allow": [], "block": []}
    for row in rows:
        assert (row.host, row.path, row.rule) == (*parts(urls[row.page_id]), rule[row.page_id])
        if row.rule:
            assert row.verdict == URL_RULES[row.rule]
        else:
            judged[row.verdict].append(row.score)
    for row in rows[:60]:
        url = urls[row.page_id]
        assert row.score == pytest.approx((accepted.log(url) - rejected.log(url)) / (len(url.encode()) + 1), abs=1e-5)
    assert not judged["block"] or not judged["allow"] or max(judged["block"]) < min(judged["allow"])


def test_learns_and_generalises(spark):
    urls = [f"https://w{i}.{'good' if i % 2 else 'casino'}.{'org/fr' if i % 2 else 'net'}/{i}" for i in range(300)]
    urls += [f"http://{name}{i}.example.com/en/" for i in range(20) for name in ("good", "casino")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = url_filter.verdicts(pages, URL_RULES).where("rule is null").collect()
    assert len(rows) == 40 and all((r.verdict == "allow") == r.host.startswith("good") for r in rows)
    held = [url for url in urls if zlib.crc32(url.encode()) % 5 == 0]
    assert held


def test_rows(spark):
    urls = [None, "", "no scheme", "HTTP://A.Example.NET/en/x?q://z", "a://net", "x://y.net?p", "http://org/fr/", "http://é.example.net/EN/", "https://u.net/#", "u" * 50_000]
    pages = spark.createDataFrame([(i % 5 if i else None, url, "k") for i, url in enumerate(urls)], "page_id long, url string, host string")
    found = {r.score: r for r in url_filter.verdicts(pages, URL_RULES).collect()}
    rows = list(url_filter.verdicts(pages, URL_RULES).collect())
    assert len(rows) == len(urls) and found
    by = {(r.host, r.path): (r.rule, r.verdict) for r in rows}
    assert by[("a.example.net", "/en/x")] == ("example.net/en/", "allow")
    assert by[("net", "")][0] is None and by[("y.net", "")][0] is None
    assert by[("org", "/fr/")] == ("org/fr/", "allow")
    assert by[("é.example.net", "/EN/")] == ("net/", "block")
    none = url_filter.verdicts(pages, {"never.example/": "block"}).collect()
    assert {r.verdict for r in none} == {"allow"}
    assert url_filter.verdicts(pages.limit(0), URL_RULES).collect() == []
