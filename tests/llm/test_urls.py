import math
import re

import pytest
from helpers import rows_of

from clickforge.llm import url_reputation as U
from clickforge.llm.queries import URL_RULES, URL_SUFFIXES


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return low, re.match(r"[^?#]*", rest[len(host):])[0]


def rule(host, path):
    best = None
    for text, says in URL_RULES:
        name, rest = text.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            best = max(best or ("", ""), (text, says), key=lambda r: len(r[0]))
    return best or (None, None)


def zone(host):
    name = re.sub(r":[0-9]*$", "", host)
    suffix = next((s for s in URL_SUFFIXES if name == s or name.endswith("." + s)), name.rsplit(".", 1)[-1])
    above = name[:max(0, len(name) - len(suffix) - 1)]
    return (above.rsplit(".", 1)[-1] + "." + suffix if above else name), suffix


def reputation(hosts):
    """{host: (n, bad)} to {host: (mean, lower)}."""
    doms, zones = {}, {}
    for h, (n, k) in hosts.items():
        d, s = zone(h)
        for table, key in ((doms, (s, d)), (zones, s)):
            a, b = table.get(key, (0, 0))
            table[key] = a + n, b + k
    m = (sum(k for _, k in hosts.values()) + 0.5) / (sum(n for n, _ in hosts.values()) + 1)

    def strength(groups):
        g = [(n, k) for n, k in groups.values() if n]
        total = sum(n for n, _ in g)
        if not g or total == sum(n * n for n, _ in g) / total + len(g) - 1:
            return 1000.0
        rho = (sum(n * (k / n - m) ** 2 for n, k in g) / (m * (1 - m)) - (len(g) - 1)) / (
            total - sum(n * n for n, _ in g) / total - (len(g) - 1))
        return max(2.0, min(1000.0, 1 / rho - 1)) if rho > 0 else 1000.0

    sz, sd, sh = strength(zones), strength(doms), strength(hosts)
    out = {}
    for h, (n, k) in hosts.items():
        d, s = zone(h)
        zm = (zones[s][1] + sz * m) / (zones[s][0] + sz)
        dm = (doms[s, d][1] + sd * zm) / (doms[s, d][0] + sd)
        mean = (k + sh * dm) / (n + sh)
        out[h] = mean, mean - math.sqrt(mean * (1 - mean) / (n + sh + 1))
    return out


def _pages():
    urls = [None, "", "no scheme", "http://", "https://A.Example.COM/en/x", "http://www.example.com/en/", "http://example.com",
            "http://example.com/EN/", "ftp://x.net/es/1?q=/fr/", "http://net/fr/", "http://notnet.org/es/", "http://u.org:80/a#b",
            "a://b://c/d", "http://É.org/x", "http://deep.sub.bad.example.org/p", "http://com/", "http://xcom/", "http://h.org?x=/"]
    urls += [f"http://{'bad' if i % 3 == 0 else 'fine'}{i % 7}.example.{('org', 'net')[i % 2]}/p/{i}" for i in range(200)]
    return list(enumerate(urls)) + [(None, "http://fine1.example.org/p"), (20, "http://fine1.example.org/p")]


def test_matches_brute_force(spark):
    pages = _pages()
    bad = [(i, i % 3 == 0 if i % 7 else i % 2 == 0) for i, _ in pages if i is not None and i % 4]
    bad += [(9999, True), (None, True), (21, None), (bad[3][0], True)]
    outcomes = {}
    for i, b in bad:
        if i is not None and b is not None:
            outcomes[i] = outcomes.get(i, False) or b
    hosts = {}
    for i, url in pages:
        n, k = hosts.get(split(url)[0], (0, 0))
        hosts[split(url)[0]] = n + (i in outcomes), k + outcomes.get(i, False)
    known, want = reputation(hosts), []
    for i, url in pages:
        host, path = split(url)
        text, says = rule(host, path)
        want.append((i, host, path, text, says or ("block" if known[host][1] > 0.3 else "allow")))
    df = spark.createDataFrame(pages, "page_id long, url string").selectExpr("*", "1 as host", "2 as n", "3 as bad", "4 as rule")
    got = U.judge_urls(df, spark.createDataFrame(bad, "page_id long, bad boolean"), URL_RULES, URL_SUFFIXES)
    assert rows_of(got.select("page_id", "host", "path", "rule", "verdict")) == sorted(want, key=repr)
    for r in got.collect():
        assert (r["mean"], r.lower) == pytest.approx(known[r.host], abs=1e-9)
    assert {"allow", "block"} == {w[4] for w in want if w[3] is None}


def test_without_outcomes_rules_or_pages(spark):
    pages = spark.createDataFrame(_pages(), "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, bad boolean")
    got = U.judge_urls(pages, none).collect()
    assert len(got) == len(_pages()) and all(r["mean"] == 0.5 and r.rule is None for r in got)
    assert U.judge_urls(pages.limit(0), none, URL_RULES).collect() == []
