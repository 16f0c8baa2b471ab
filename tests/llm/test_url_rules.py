"""Url verdicts against plain rules and all token combinations."""

import itertools
import random
import re
from collections import Counter

import pytest

from rolecall.llm import queries, url_rules

URLS = [
    None, "", "no scheme/x", "://", "http://", "http://NET/", "http://a.net", "http://a.net/", "http://xnet/", "https://EXAMPLE.net/en/1?x=1", "http://example.net/EN/1",
    "http://a.b.example.net/en/", "http://example.net/en", "http://example.com/de/5#t", "http://wexample.com/de/5", "http://m.example.com/de/5",
    "http://x.org/fr/a?b", "http://x.org/fr?/fr/", "http://a?u=http://b.net/", "http://a#://c.net/", "http://a.net:80/", "x://y://z.org/fr/", "http://ÀB.org/fr/é\n?q",
    "http://a..net//", "http://" + "a." * 3000 + "net/" + "b/" * 3000,
]


def host_and_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    host = re.split(r"[/?#]", rest)[0]
    path = re.split(r"[?#]", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path):
    fits = [
        r for r in (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
        if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])
    ]
    best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
    return (best[1] + best[2], best[0]) if best else (None, None)


def tokens_of(url):
    host, path = host_and_path(url)
    if not host:
        return frozenset()
    out = [f"host:{x}" for x in host.split(".") if x] + [f"path:{x}" for x in path.split("/") if x]
    ending = re.search(r"\.([A-Za-z0-9]+)\Z", path)
    if ending:
        out.append(f"ending:{ending[1]}")
    before = url.split("#")[0]
    query = before.split("?", 1)[1] if "?" in before else ""
    return frozenset(out + [f"argument:{x.split('=')[0]}" for x in query.split("&") if x.split("=")[0]])


def judge(urls, support, rows, confidence):
    """Verdicts, with every combination of frequent tokens counted."""
    parted = [(*host_and_path(u), *rule_of(*host_and_path(u)), tokens_of(u)) for u in urls]
    sets = {(t, v) for _, _, _, v, t in parted if v}
    least = max(rows, support * len(sets))
    n = Counter(x for t, _ in sets for x in t)
    holders = {x: frozenset(s for s in sets if x in s[0]) for x in n if n[x] >= least}
    first = {h: min(x for x in holders if holders[x] == h) for h in holders.values()}
    known = sorted(first.values())
    counts: Counter = Counter()
    for t, v in sets:
        own = [x for x in known if x in t]
        for size in range(1, len(own) + 1):
            for some in itertools.combinations(own, size):
                counts[some, v] += 1
                counts[some] += 1
    mined = []
    for key, both in counts.items():
        if isinstance(key[0], tuple) and both >= least and both / counts[key[0]] >= confidence:
            mined.append((key[0], key[1], both / counts[key[0]], both / len(sets)))
    kept = [r for r in mined if not any(o[1] == r[1] and set(o[0]) < set(r[0]) and o[2] >= r[2] for o in mined)]
    out = []
    for host, path, rule, verdict, tokens in parted:
        follow = min((r for r in kept if set(r[0]) <= tokens), key=lambda r: (-r[2], -r[3], -len(r[0]), r[0]), default=None) if rule is None else None
        out.append((host, path, rule, verdict or (follow[1] if follow else "allow"), " ".join(follow[0]) if follow else None))
    return out


def made_up(seed):
    rng = random.Random(seed)
    tops = ["example.com", "example.net", "example.org", "site.net", "b.org"]
    urls = []
    for _ in range(1500):
        host = rng.choice(["", "www.", "m.", "blog.", "casino.", "ads."]) + rng.choice(tops)
        path = "/" + rng.choice(["en", "fr", "de", "es"]) + "/" + str(rng.randrange(400)) + rng.choice(["", "/", ".html", "/deep/er/still"])
        urls.append(f"http://{host}{path}{rng.choice(['', '?utm=1&page=2', '#top', '?x'])}")
    return urls + ["http://hot.site.net/de/1"] * 700 + URLS


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("confidence", [0.6, 0.9])
def test_as_plain(spark, seed, confidence):
    urls = made_up(seed)
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id bigint, url string, host string, tokens string").repartition(5)
    found = url_rules.judge_urls(df, least_support=0.02, least_confidence=confidence).collect()
    want = judge(urls, 0.02, 20, confidence)
    assert len(found) == len(urls) and any(w[4] for w in want)
    for r in found:
        assert tuple(r)[1:] == want[r["page_id"]]


def test_odd_urls(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, "http://a.net/"), (1, ""), (1, "")]
    found = url_rules.judge_urls(spark.createDataFrame(rows, "page_id bigint, url string")).collect()
    assert len(found) == len(rows)
    for r in found:
        if r["page_id"] is not None:
            host, path = host_and_path(rows[r["page_id"]][1])
            rule, verdict = rule_of(host, path)
            assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict or "allow")
    empty = spark.createDataFrame([], "page_id bigint, url string")
    assert url_rules.judge_urls(empty).collect() == []


def test_longest_rule_wins(spark):
    rules = [url_rules.Rule("block", "a.b", "/x/"), url_rules.Rule("allow", "b", "/x/yz/"), url_rules.Rule("block", "b", "/x/yz/"), url_rules.Rule("allow", "c.a.b", "/x/")]
    df = spark.createDataFrame([(1, "http://c.a.b/x/yz/1"), (2, "http://q.a.b/x/1"), (3, "http://d.b/x/yz/")], "page_id bigint, url string")
    found = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_rules.judge_urls(df, rules=rules).collect()}
    assert found == {1: ("c.a.b/x/", "allow"), 2: ("a.b/x/", "block"), 3: ("b/x/yz/", "block")}


def test_long_shared_paths_have_few_combinations(spark):
    """Sixty tokens that always come together are one: no 2**60 combinations."""
    path = "/".join(f"s{i}" for i in range(60))
    rows = [(i, f"http://h.net/{path}/{i}") for i in range(300)] + [(1000, f"http://h.com/{path}/1")]
    found = {r["page_id"]: r["verdict"] for r in url_rules.judge_urls(spark.createDataFrame(rows, "page_id bigint, url string")).collect()}
    assert found[1000] == "block" and len(found) == 301


def test_query(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    found = {r["page_id"]: r for r in queries.QUERIES["op13_url_rules"](spark, "/root/testdata/sf0.001").collect()}
    assert len(found) == len(pages)
    for p in pages:
        r = found[p["page_id"]]
        host, path = host_and_path(p["url"])
        rule, verdict = rule_of(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and r["verdict"] in ((verdict,) if verdict else ("allow", "block"))
