"""The whole URL query against a plain version of the same definition, and on verdicts that it has not seen."""

import math
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from sheafline.llm import url_filter
from sheafline.llm.common import fold
from sheafline.llm.url_filter import RULES, judge_urls

SCHEMA = "page_id long, url string, purity string, n int"


def parts(url):
    found = re.match(r"^.*?://([^/?#]*)([^?#]*)", url or "", re.DOTALL)
    return ("".join(c.lower() if "A" <= c <= "Z" else c for c in found[1]), found[2]) if found else ("", "")


def rule_of(host, path, rules):
    fits = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    return max(fits, key=lambda r: (len(r[1]) + len(r[2]), r[1], r[2]), default=None)


def brute(urls, rules, z=1.96, slack=0.05, smoothing=2.0, silent=1.0, reject=0.8):
    pages = []
    for u in urls:
        host, path = parts(u)
        rule = rule_of(host, path, rules)
        segs = tuple("*" if re.search("[0-9]", s) or len(s) >= 25 else s for s in path.split("/") if s)
        pages.append((host, path, rule, segs))

    def sums(some):
        some = list(some)
        return len(some), sum(p[2] is not None and p[2][0] == "block" for p in some), sum(p[2] is not None and p[2][0] == "allow" for p in some)

    def pure(some, inherited):
        n, bad, good = sums(some)
        rest = smoothing + silent * (n - bad - good)
        return (bad + rest * inherited) / (bad + good + rest)

    def near(part, whole, pool_part, pool):
        rate = pool_part / max(pool, 1)
        return abs(part / max(whole, 1) - rate) <= slack + z * math.sqrt(rate * (1 - rate) / max(whole, 1))

    found = {}

    def grow(some, gen, p):
        level = len(gen)
        if len({x[3] for x in some}) == 1:
            found.update({(x[0], x[3]): (gen + x[3][level:], p) for x in some})
            return
        kids = defaultdict(list)
        for x in some:
            if len(x[3]) > level:
                kids[x[3][level]].append(x)
            else:
                found[x[0], x[3]] = (gen, p)
        stats = {}
        for seg, own in kids.items():
            n, bad, good = sums(own)
            kind = "none" if not bad + good else "block" if bad >= good else "allow"
            stats[seg] = kind, [n, bad, good, sum(len(x[3]) == level + 1 for x in own), sum(x[3][level + 1 : level + 2] == ("*",) for x in own)]
        merged = defaultdict(list)
        for seg, (kind, (n, bad, good, ends, varies)) in stats.items():
            alike = [s for k, s in stats.values() if k == kind]
            _n, _bad, _good, _ends, _varies = map(sum, zip(*alike, strict=True))
            similar = len(alike) > 1 and near(ends, n, _ends, _n) and near(varies, n, _varies, _n) and near(bad, bad + good, _bad, _bad + _good)
            merged[{"block": "/*block", "allow": "/*allow", "none": "*"}[kind] if similar else seg] += kids[seg]
        for name, own in merged.items():
            grow(own, (*gen, name), pure(own, p) if len(own) < len(some) else p)

    prior = pure(pages, 0.5)
    for host in {x[0] for x in pages}:
        labels = host.split(".") if len(host) <= 253 else [host]
        p, held = prior, len(pages)
        for i in range(len(labels) - 1, -1, -1):
            domain = ".".join(labels[i:])
            own = [x for x in pages if x[0] == domain or len(x[0]) <= 253 and x[0].endswith("." + domain)] if domain else [x for x in pages if x[0] == ""]
            p, held = pure(own, p) if len(own) < held else p, len(own)
        grow([x for x in pages if x[0] == host], (), p)
    return [(h, q, r and r[1] + r[2], found[h, s][0], round(found[h, s][1], 9), r[0] if r else "block" if found[h, s][1] >= reject else "allow") for h, q, r, s in pages]


def got(df):
    return [(r["host"], r["path"], r["rule"], tuple(r["template"]), round(r["purity"], 9), r["verdict"]) for r in df.orderBy("page_id").collect()]


def test_against_brute_force(spark):
    rng = random.Random(4)
    urls = [None, "", "no scheme", "s://", "http://com", "http://example.com/" + "/".join(f"deep{c}" for c in "abcdefgh" * 60), "http://h.example.com/de/" + "x" * 100_000, "http://" + "a." * 200 + "com/x"]
    for _ in range(500):
        host = rng.choice(["a.example.com", "b.example.com", "c.example.org", "d.example.org", "x.net", "example.net", "other.io", "spam.example.com"])
        lang = rng.choice(["de"] * 9 + ["en"]) if host.startswith("spam") else rng.choice(["en", "de", "fr", "es"])
        tail = rng.choice(["", f"/{rng.randrange(99)}", f"/news/{rng.randrange(99)}", "/about", f"/news/{rng.choice('abc')}/{rng.choice('de')}"])
        urls.append(f"https://{host}/{lang}{tail}{rng.choice(['', '?q=1', '#x'])}")
    urls += urls[10:40]  # repeated pages
    rows = spark.createDataFrame([(i, u, "clash", 1) for i, u in enumerate(urls)], SCHEMA)
    expected = brute(urls, RULES)
    assert got(judge_urls(rows, RULES)) == expected
    free = [x for x in expected if x[2] is None]
    assert len({x[4] for x in free}) > 5 and {x[5] for x in free} == {"allow", "block"}


def test_verdicts_that_were_hidden(spark):
    """A quarter of the pages' rule verdicts is kept from learning; their templates tell them all the same."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    out = judge_urls(pages, RULES, learn_from=fold("page_id") != 2)
    hidden = out.where("rule is not null").where(fold("page_id") == 2).select("verdict", (F.col("purity") >= 0.5).alias("bad")).collect()
    assert len(hidden) > 200 and sum((r["verdict"] == "block") == r["bad"] for r in hidden) >= 0.95 * len(hidden)


def test_shared_segments_take_no_rounds_of_their_own(spark, monkeypatch):
    tables, stored = [], url_filter.stored
    monkeypatch.setattr(url_filter, "stored", lambda df, name: tables.append(name) or stored(df, name))

    def run(shared):
        tables.clear()
        stem = "https://a.example.com/" + "/".join(f"part{'abcdefghij'[i % 10]}" for i in range(shared))
        urls = [f"{stem}/x/end", f"{stem}/y", stem, f"{stem}/x", "https://a.example.com/", "https://a.example.com/de/1", f"{stem}/x/other/z", f"{stem}/x/other/w"]
        assert got(judge_urls(spark.createDataFrame([(i, u, "clash", 1) for i, u in enumerate(urls)], SCHEMA), RULES)) == brute(urls, RULES)
        return len(tables)

    assert run(200) == run(5)
