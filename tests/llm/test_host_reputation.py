"""Addresses, rules and posteriors against plain Python."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from spikewatch.llm import host_reputation as h

RULES = [
    h.rule("allow", "com/"),
    h.rule("block", "example.com/en/"),
    h.rule("allow", "www.example.com/en/"),
    h.rule("block", "net/es/"),
]


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def pages(spark, urls):
    rows = [(n, u, "html", "x") for n, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string")


def test_addresses_and_rules(spark):
    cases = [
        (None, "", "", None),
        ("no scheme", "", "", None),
        ("http://", "", "", None),
        ("https://A.Example.COM/en/x?y=/z#t", "a.example.com", "/en/x", "example.com/en/"),
        ("http://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/"),
        ("http://deep.www.example.com/en/1", "deep.www.example.com", "/en/1", "www.example.com/en/"),
        ("http://badexample.com/en/1", "badexample.com", "/en/1", "com/"),
        ("http://example.com", "example.com", "", None),
        ("http://example.com?/en/", "example.com", "", None),
        ("http://x.net/es/a://b", "x.net", "/es/a://b", "net/es/"),
        ("http://x.net/ES/", "x.net", "/ES/", None),
        ("a b://É.org#/x", "É.org", "", None),
        ("x\ny://h.com/p\nq", "h.com", "/p\nq", "com/"),
    ]
    got = h.judge_urls(pages(spark, [c[0] for c in cases]), labels(spark), RULES)
    rows = got.orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule) for r in rows] == [c[1:] for c in cases]
    verdicts = {r.name: r.verdict for r in RULES} | {None: "allow"}
    assert [r.verdict for r in rows] == [verdicts[c[3]] for c in cases]


def test_posteriors(spark):
    hosts = ["good.a.org", "bad.a.org", "new.a.org", "only.b.co.uk", "x.c.org", "d"]
    urls, marks = [], []
    for n in range(240):
        host = hosts[n % 6]
        urls.append(f"http://{host}/{n}")
        if host != "new.a.org":
            bad = host == "bad.a.org" or n % 17 == 0
            marks.append((n, 0 if bad and n % 2 else 1, int(bad and not n % 2)))
    marks += [(1, 1, 0), (9999, 0, 1), (None, 0, 0), (3, None, None)]
    got = h.judge_urls(pages(spark, urls), labels(spark, marks), []).collect()
    bad_of = defaultdict(int)
    for doc, quality, toxic in marks:
        if doc is not None and quality is not None and doc < 240:
            bad_of[doc] = max(bad_of[doc], int(quality == 0 or toxic == 1))
    n_of, b_of = defaultdict(int), defaultdict(int)
    for doc, bad in bad_of.items():
        n_of[hosts[doc % 6]] += 1
        b_of[hosts[doc % 6]] += bad
    suffix = {x: "co.uk" if x.endswith("co.uk") else x.split(".")[-1] for x in hosts}
    domain = {x: "b.co.uk" if x.endswith("co.uk") else ".".join(x.split(".")[-2:]) for x in hosts}

    def level(group):
        n, b = defaultdict(int), defaultdict(int)
        for x in hosts:
            n[group[x]] += n_of[x]
            b[group[x]] += b_of[x]
        return n, b

    def strength(n, b, centre):
        room = sum(n[g] * (n[g] - 1) * m * (1 - m) for g, m in centre.items())
        extra = sum((b[g] - n[g] * m) ** 2 - n[g] * m * (1 - m) for g, m in centre.items())
        if not room or extra <= 0:
            return h.STRONGEST
        return min(max(room / extra - 1, h.WEAKEST), h.STRONGEST)

    overall = (sum(b_of.values()) + 1) / (sum(n_of.values()) + 2)
    n, b = level(suffix)
    by_suffix = {g: (b[g] + overall * h.SUFFIX_STRENGTH) / (n[g] + h.SUFFIX_STRENGTH) for g in n}
    n, b = level(domain)
    centre = {domain[x]: by_suffix[suffix[x]] for x in hosts}
    s = strength(n, b, centre)
    by_domain = {g: (b[g] + centre[g] * s) / (n[g] + s) for g in n}
    centre = {x: by_domain[domain[x]] for x in hosts}
    s = strength(n_of, b_of, centre)
    for r in got:
        rate = (b_of[r.host] + centre[r.host] * s) / (n_of[r.host] + s)
        bound = rate - (rate * (1 - rate) / (n_of[r.host] + s + 1)) ** 0.5
        assert r.rate == pytest.approx(rate) and r.bound == pytest.approx(bound)
        assert r.verdict == ("block" if bound > 0.35 else "allow") and r.rule is None
    assert {r.host for r in got if r.verdict == "block"} == {"bad.a.org"}


def test_empty_tables(spark):
    assert h.judge_urls(pages(spark, []), labels(spark), RULES).select(F.count("*")).first()[0] == 0
