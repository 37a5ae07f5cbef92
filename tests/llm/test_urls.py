import random

import pytest

from lastro.llm import urls


def reference(url):
    """Host, path and rule by hand."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = rest
    for mark in "/?#":
        host = host.split(mark, 1)[0]
    path = rest[len(host):]
    for mark in "?#":
        path = path.split(mark, 1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule in urls.RULES:
        if (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path):
            if best is None or len(rule.name) > len(best.name):
                best = rule
    return host, path, best and best.name, best and best.verdict


ODD = [
    None, "", "no scheme", "http://", "://x.net/", "http://NET/", "http://net", "http://a.net?x=/en/", "https://EXAMPLE.net/en/1#y",
    "http://notexample.net/en/1", "http://b.example.com/de", "http://b.example.com/de/", "http://x.org/fr/?q", "http://É.org/fr/é",
    "http://a.com/http://b.net/", "http://x.com/a\nb/c?d", "http://x.org//fr/",
]


def test_odd_urls(spark):
    rows = [(i if i else None, u, "x") for i, u in enumerate(ODD)] + [(1, ODD[1], "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    found = urls.judge(pages).collect()
    assert len(found) == len(rows)
    for row in found:
        host, path, rule, verdict = reference(ODD[row.page_id or 0])
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == (verdict or "allow")
    assert urls.judge(pages.limit(0)).collect() == []


def test_given_urls(spark, folder):
    from lastro.llm.queries import QUERIES

    given = {r.page_id: r.url for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    for row in QUERIES["op5_url_filter"](spark, folder).collect():
        host, path, rule, verdict = reference(given[row.page_id])
        assert (row.host, row.path, row.rule) == (host, path, rule)
        assert row.verdict == (verdict or "allow")


def test_templates_generalise_merge_and_reject(spark):
    rng, rules = random.Random(3), (urls.Rule("block", "shop", "/offers/a/"), urls.Rule("block", "shop", "/offers/b/"), urls.Rule("allow", "shop", "/news/"))
    rows = [f"http://shop/offers/{rng.choice('ab')}/{rng.randrange(10**6)}" for _ in range(60)]
    rows += [f"http://shop/news/{rng.choice(['x', 'y'])}/{i}" for i in range(40)]
    rows += ["http://shop/offers/a", "http://shop/about/us", "http://shop/1/2/3/4/5/6/7/8/9/10"]
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    found = {rows[r.page_id]: r for r in urls.judge(pages, rules).collect()}
    templates = {u: r.template for u, r in found.items()}
    assert {t for u, t in templates.items() if "/offers/" in u and u.count("/") > 4} == {"/=offers/+/*"}
    assert {t for u, t in templates.items() if "/news/" in u} == {"/=news/+/*"}
    assert templates["http://shop/1/2/3/4/5/6/7/8/9/10"].endswith("/**")
    assert found["http://shop/about/us"].verdict == "allow"
    assert all(found[u].verdict == "block" for u in rows[:60])


@pytest.mark.parametrize("missed", [0, 3])
def test_undecided_urls_follow_their_template(spark, missed):
    rules = (urls.Rule("block", "bad.site", "/x/1"), urls.Rule("allow", "bad.site", "/x/9"))
    rows = [f"http://bad.site/x/1{i}" for i in range(30)] + [f"http://bad.site/x/9{i}" for i in range(missed)] + ["http://bad.site/x/555"]
    pages = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    last = max(urls.judge(pages, rules).collect(), key=lambda r: r.page_id)
    assert (last.template, last.rule, last.verdict) == ("/=x/*", None, "block")
