import random
import re

import duckdb
import pandas as pd
import pytest

from trackmill.llm.queries import URL_FILTER_SQL
from trackmill.llm.url_filter import FOLLOWED, LEAST_DISTRUST, LEAST_SHARE, RULES, STEPS, judge_urls


def parts(url):
    found = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    if not found:
        return "", ""
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in found[1]), found[2]


def rule_of(host, path):
    fitting = [
        r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return max(fitting, key=lambda r: len(r.host + r.path), default=None)


def ranks(edges, seeds):
    out = {}
    for (src, _), n in edges.items():
        out[src] = out.get(src, 0) + n
    own = {h: s * (1 - FOLLOWED) for h, s in seeds.items()}
    now = dict(own)
    for _ in range(STEPS):
        new = dict(own)
        for (src, dst), n in edges.items():
            if src in now:
                new[dst] = new.get(dst, 0.0) + FOLLOWED * now[src] * n / out[src]
        now = new
    return now


def shares(edges, seeds):
    """By host, what links bring of all that they could bring, or the host's own start."""
    own, whole = ranks(edges, seeds), ranks(edges, {h: 1.0 for edge in edges for h in edge})
    out = {}
    for host, rank in own.items():
        start = seeds.get(host, 0.0)
        most = whole.get(host, 0.0) - (1 - FOLLOWED)
        out[host] = max(start, (rank - start * (1 - FOLLOWED)) / most if most > 0 else 0.0)
    return out


def expected(rows, fixed=True):
    edges, count, seeds = {}, {}, {"allow": {}, "block": {}}
    for _, url, html in rows:
        host, path = parts(url)
        if not host:
            continue
        count[host] = count.get(host, 0) + 1
        rule = rule_of(host, path)
        if rule:
            seeds[rule.verdict][host] = seeds[rule.verdict].get(host, 0) + 1
        links = set(re.findall(r"""href="((?:https?:)?//[^"]+)""", html or ""))
        for link in links:
            target, _ = parts(re.sub("^(https?:)?", "http:", link))
            if target and target != host:
                edges[host, target] = edges.get((host, target), 0) + 1
    share = {v: {h: n / count[h] for h, n in own.items()} for v, own in seeds.items()}
    figure, least = (ranks, LEAST_DISTRUST * (1 - FOLLOWED)) if fixed else (shares, LEAST_SHARE)
    trust = figure(edges, share["allow"])
    distrust = figure({(b, a): n for (a, b), n in edges.items()}, share["block"])
    for page_id, url, _ in rows:
        host, path = parts(url)
        rule = rule_of(host, path)
        d, t = distrust.get(host, 0.0) if host else 0.0, trust.get(host, 0.0) if host else 0.0
        bad = d >= least and d > t
        yield page_id, host, path, rule and rule.host + rule.path, rule.verdict if rule else ("block" if bad else "allow")


SCHEMA = "page_id long, url string, html string, host string, verdict string"


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    choose = random.Random(seed)
    hosts = [f"h{i}.{end}" for i in range(12) for end in ("example.com", "example.net", "org", "info")] + ["notnet", "xnet", "net"]
    rows = []
    for i in range(300):
        links = "".join(
            f'<a href="{choose.choice(["http:", "https:", ""])}//{choose.choice(hosts).upper() if choose.random() < .2 else choose.choice(hosts)}/x">'
            for _ in range(choose.randint(0, 5))
        )
        url = f"http://{choose.choice(hosts)}{choose.choice(['', '/', '/en/1', '/de/2?x=/fr/', '/fr/3#a', '?q', '#z'])}"
        rows.append((i, url, links + '<a href="/own">'))
    pages = spark.createDataFrame([(*row, "x", "y") for row in rows], SCHEMA).repartition(3)
    found = [tuple(r) for r in judge_urls(pages, least_distrust=LEAST_DISTRUST).select("id", "host", "path", "rule", "verdict").collect()]
    assert sorted(found) == sorted(expected(rows), key=lambda r: r[0])
    # The registered SQL says the same where pages link to one another.
    connection = duckdb.connect()
    connection.register("frame", pd.DataFrame(rows, columns=["page_id", "url", "html"]))
    connection.execute("CREATE TABLE pages AS SELECT * FROM frame")
    assert sorted(connection.execute(URL_FILTER_SQL).fetchall()) == sorted(found)
    assert {r[4] for r in found if r[3] is None} == {"allow", "block"}


def test_odd_rows(spark):
    rows = [(1, None, None), (None, "no scheme", ""), (2, "HTTP://A.NET", None), (2, "HTTP://A.NET", None), (3, "x://", "<a href="),
            (4, "http://a://b/c", 'x' * 100_000), (5, "http://ÀB.Net/É?", "")]
    pages = spark.createDataFrame([(*row, None, None) for row in rows], SCHEMA)
    found = [tuple(r) for r in judge_urls(pages, least_distrust=LEAST_DISTRUST).select("id", "host", "path", "rule", "verdict").collect()]
    assert sorted(found, key=str) == sorted(expected(rows), key=str)
    assert judge_urls(pages.limit(0)).count() == 0


@pytest.mark.parametrize("seed", [3, 4])
def test_shares_against_brute_force(spark, seed):
    choose = random.Random(seed)
    hosts = [f"h{i}.{end}" for i in range(12) for end in ("example.com", "org", "info", "net")]
    rows = []
    for i in range(200):
        links = "".join(f'<a href="http://{choose.choice(hosts)}/x">' for _ in range(choose.randint(0, 3)))
        rows.append((i, f"http://{choose.choice(hosts)}{choose.choice(['/', '/de/2', '/fr/3'])}", links))
    pages = spark.createDataFrame([(*row, "x", "y") for row in rows], SCHEMA).repartition(3)
    found = [tuple(r) for r in judge_urls(pages).select("id", "host", "path", "rule", "verdict").collect()]
    assert sorted(found) == sorted(expected(rows, fixed=False), key=lambda r: r[0])
    assert {r[4] for r in found if r[3] is None} == {"allow", "block"}


@pytest.mark.parametrize("others", [0, 1, 40])
def test_verdict_of_a_site_does_not_depend_on_others_that_link_alike(spark, others):
    bad, fair = '<a href="http://bad.net/">', '<a href="http://fair.info/">'
    rows = [
        (0, "http://bad.net/", ""), (1, "http://fair.info/", ""), (2, "http://only.info/", bad),
        (3, "http://mostly.info/", fair), (4, "http://mostly.info/2", fair), (5, "http://mostly.info/3", fair + bad),
        (6, "http://lone.info/", ""), *((10 + i, f"http://other{i}.info/", bad + fair) for i in range(others)),
    ]
    pages = spark.createDataFrame([(*row, None, None) for row in rows], SCHEMA)
    found = {r["id"]: r["verdict"] for r in judge_urls(pages).collect()}
    assert [found[i] for i in range(7)] == ["block", "allow", "block", "allow", "allow", "allow", "allow"]


def test_odd_rows_by_shares(spark):
    rows = [(1, None, None), (None, "no scheme", ""), (2, "HTTP://A.NET", None), (2, "HTTP://A.NET", None), (4, "http://a://b/c", "x")]
    pages = spark.createDataFrame([(*row, None, None) for row in rows], SCHEMA)
    found = [tuple(r) for r in judge_urls(pages).select("id", "host", "path", "rule", "verdict").collect()]
    assert sorted(found, key=str) == sorted(expected(rows, fixed=False), key=str)
    assert judge_urls(pages.limit(0)).count() == 0
