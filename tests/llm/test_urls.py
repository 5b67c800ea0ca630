import re

import pytest

from basket.llm import urls

SCHEMA = "page_id long, url string, html string"


def a(*links):
    return "<p>" + "".join(f'<a HREF="{x}">x</a>' for x in links)


PAGES = [
    (1, "http://good.org/a", a("http://near.net/x", "/local", "//near.net/y", "mailto:x@y.z")),
    (2, "https://BAD.example.net/spam/1?q", a("http://good.org/")),
    (3, "http://near.net/x", a("http://far.net/")),
    (4, "http://far.net:80/p#f", None),
    (5, "http://links-to-bad.net", a("http://bad.example.net/spam/1", "http://links-to-bad.net/self")),
    (6, None, a("http://good.org/")),
    (7, "no scheme/path", ""),
    (8, "http://mixed.net/", a("http://good.org/", "http://bad.example.net/")),
    (8, "http://mixed.net/", a("http://good.org/", "http://bad.example.net/")),
    (None, "x://sub.good.org/a/b?c=http://other", a()),
    (9, "http://alone.net/", a("http://ÄÖ.net/")),
]
RULES = [("org", "/", "allow"), ("good.org", "/a/", "block"), ("bad.example.net", "/spam/", "block"), ("example.net", "/spam/1", "allow")]


def parse(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    if not m:
        return "", ""
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]


def brute(pages, rules, rounds=400, damping=urls.DAMPING):
    judged = []
    for _, url, _ in pages:
        host, path = parse(url)
        fits = [(len(h + p), v == "block", h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        judged.append((host, path, max(fits, default=None)))
    hosts, edges = {}, {}
    for (_, _, html), (host, _, best) in zip(pages, judged, strict=True):
        if host:
            hosts.setdefault(host, []).append(best)
        for link in re.findall(r"""(?i)\bhref\s*=\s*["']?([^"'>\s]*)""", html or ""):
            if link.startswith("//") or "://" in link:
                to = parse("http:" + link if link.startswith("//") else link)[0]
                if host and to and to != host:
                    edges[host, to] = edges.get((host, to), 0) + 1
    seed = {h: (sum(b is not None and not b[1] for b in own) / len(own), sum(b is not None and b[1] for b in own) / len(own)) for h, own in hosts.items()}
    for e in edges:
        for h in e:
            seed.setdefault(h, (0.0, 0.0))
    rank = dict(seed)
    for _ in range(rounds if edges else 1):
        new = {h: [(1 - damping) * t, (1 - damping) * d] for h, (t, d) in seed.items()}
        for (s, d), n in edges.items():
            new[d][0] += damping * rank[s][0] * n / sum(v for (x, _), v in edges.items() if x == s)
            new[s][1] += damping * rank[d][1] * n / sum(v for (_, x), v in edges.items() if x == d)
        rank = new
    out = []
    for (page, _, _), (host, path, best) in zip(pages, judged, strict=True):
        t, d = rank.get(host, (0.0, 0.0))
        verdict = ("block" if best[1] else "allow") if best else "block" if d > 0.5 * (t + d) else "allow"
        out.append((page, host, path, best[2] if best else None, verdict, round(t, 9), round(d, 9)))
    return sorted(out, key=str)


@pytest.mark.parametrize("pages", [PAGES, [(i, u, None) for i, u, _ in PAGES]])
def test_against_a_plain_propagation(spark, pages):
    found = urls.filter_urls(spark.createDataFrame(pages, SCHEMA), RULES).collect()
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict, round(r.trust, 9), round(r.distrust, 9)) for r in found), key=str)
    assert got == brute(pages, RULES)


def test_verdicts(spark):
    found = {r.page_id: r.verdict for r in urls.filter_urls(spark.createDataFrame(PAGES, SCHEMA), RULES).collect()}
    assert found[3] == found[4] == "allow"  # reached from a trusted host
    assert found[5] == "block"  # links to a blocked one
    assert found[6] == found[7] == found[9] == "allow"


def test_empty_and_no_rules(spark):
    pages = spark.createDataFrame(PAGES, SCHEMA)
    assert urls.filter_urls(pages.limit(0), RULES).collect() == []
    assert {r.verdict for r in urls.filter_urls(pages.selectExpr("*", "1 AS host", "2 AS rule"), []).collect()} == {"allow"}


def test_runs_no_python(spark):
    plan = urls.filter_urls(spark.createDataFrame(PAGES, SCHEMA), RULES)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_long_chains_and_cycles(spark):
    """Distrust goes back over 15 links to the first host of a chain; a cycle's scores converge."""
    chain = [(i, f"http://c{i}.net/", a(f"http://c{i + 1}.net/")) for i in range(15)] + [(15, "http://c15.net/bad/", None)]
    found = {r.page_id: r.verdict for r in urls.filter_urls(spark.createDataFrame(chain, SCHEMA), [("c15.net", "/bad/", "block")]).collect()}
    assert found == dict.fromkeys(range(16), "block")
    cycle = [(0, "http://x.org/", a("http://y.net/")), (1, "http://y.net/", a("http://z.net/")), (2, "http://z.net/", a("http://y.net/"))]
    got = urls.filter_urls(spark.createDataFrame(cycle, SCHEMA), [("org", "/", "allow")], tolerance=1e-4).collect()
    want = {r[0]: r[5] for r in brute(cycle, [("org", "/", "allow")])}
    assert all(abs(r.trust - want[r.page_id]) < 1e-3 for r in got)
