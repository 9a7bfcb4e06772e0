import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stratum.llm import urlrules as U
from stratum.llm.queries import URL_RULES

LOWER = str.maketrans(U._UPPER, U._LOWER)


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host):])[0]


def judge(url, rules):
    host, path = split(url)
    best = None
    for h, p, v in rules:
        if host and h and (host == h or host.endswith("." + h)) and path.startswith(p or ""):
            best = max(best or (-1, "", ""), (len(h) + len(p or ""), h + (p or ""), v))
    return host, path, best[1] if best else None, best[2] if best else U.DEFAULT


URLS = [None, "", "no scheme", "http://", "http://ORG/", "https://a.org", "https://a.org?x=/es/", "http://example.org/es/1", "http://EXAMPLE.org/en/12#y",
        "http://x.example.org/en/2", "http://badexample.org/es/", "ftp://fr.com/fr/a?b", "http://fr.com/de/", "http://u:p@fr.com:80/fr/", "http://é.org/ü",
        "http://a..org/x", "http://.org/", "x://y://z.org/", "http://org.com/", "http://a.org/\nfr/", "http://org,example/es/x", "http://a.org,example/en/1", "http://org)/es/", "http://example.org)/es/1", "http://a,b.org/e", "http://a)b.org/e", "http://" + "a." * 60 + "org/" + "p/" * 2000]


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "x", "x", "x", "x") for i, u in enumerate(urls)],
                                 "page_id long, url string, key string, rule string, verdict string, first string")


@pytest.mark.parametrize("rules", [URL_RULES, [], [("org", "", "block"), ("org", "/e", "allow"), ("a.org", "/", "block"), ("com", None, "block"), ("", "/", "block"),
                                               (None, "/", "block"), ("fr.com", "/fr", "allow"), ("fr.com", "/fr", "block"), ("COM", "/fr/", "allow"), ("a/b", "/", "block"),
                                               ("org)", "", "allow"), ("a,b.org", "/", "block"), ("b.org", "", "block")]])
def test_verdicts_equal_brute_force(spark, rules):
    urls = URLS * 2 + ["http://hot.example.org/en/1"] * 60 + [f"http://hot.example.org/e{'ns'[i % 2]}/{i}" for i in range(60)]
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge(pages(spark, urls), table).collect()}
    assert len(got) == len(urls)
    fixed = [(h.translate(LOWER), p, v) for h, p, v in rules if h]
    assert [got[i] for i in range(len(urls))] == [judge(u, fixed) for u in urls]


def test_partitions_that_begin_inside_intervals(spark):
    """Many keys under few rules: most partitions begin inside intervals opened before them."""
    rng = np.random.default_rng(0)
    urls = [f"http://{'abc'[rng.integers(3)]}.x.org/{'/'.join('pq'[b] for b in rng.integers(0, 2, 6))}" for _ in range(3000)]
    rules = [("org", "", "block"), ("x.org", "/p", "allow"), ("a.x.org", "/p/q", "block"), ("x.org", "/p/q/p", "allow"), ("b.x.org", "/q/q/q/q", "block")]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.judge(pages(spark, urls), U.rule_table(spark, rules)).collect()}
    assert [got[i] for i in range(len(urls))] == [judge(u, rules) for u in urls]
    assert U.judge(pages(spark, urls).where("false"), U.rule_table(spark, rules)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aA.:/?#\n é,)", max_size=25))
def test_plain_split_is_the_contract(url):
    host, path = split(url)
    assert not set("/?#") & set(host) and not set("?#") & set(path)
