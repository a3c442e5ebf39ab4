"""URL rules against a plain loop."""

from ballstats.llm import url_filters

URLS = [
    "http://example.org/en/1", "https://A.Example.ORG/en/123?q#f", "http://example.org/es/", "http://myexample.org/es/x", "http://org",
    "http://org/", "http://x.com/de/", "http://x.com/fr/a", "http://x.com/DE/", "http://com/de/1", "ftp://h/p", "no scheme", "", None,
    "http://", "http://?q", "http://a.com#x/de/", "http://a..com/de/", "http://example.org./en/1", "x://y://com/de/", "http://É.com/de/ü\n/z",
]


def plain(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([k for k in (rest.find(c) for c in "/?#") if k >= 0], default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
        path = rest[end:]
        path = path[: min([k for k in (path.find(c) for c in "?#") if k >= 0], default=len(path))]
    fits = [(len(h + p), len(h), v, h + p) for h, p, v in rules if h and p is not None and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[3] if best else None, best[2] if best else "allow"


def check(spark, urls, rules):
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(urls)] * 2, "page_id long, url string").selectExpr("*", "'x' as html", "1 as digest", "2 as rule")
    found = url_filters.judged(pages, url_filters.rule_table(spark, rules))
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    want = sorted(((k, *plain(u, rules)) for k, u in enumerate(urls)), key=repr)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want * 2, key=repr)


def test_rules(spark):
    check(spark, URLS, url_filters.RULES)


def test_precedence_and_odd_rules(spark):
    rules = [("com", "", "block"), ("a.com", "/d", "allow"), ("com", "/de", "block"), ("a.com", "/d", "block"), ("", "/", "block")]
    check(spark, ["http://a.com/de", "http://b.com/de", "http://a.com/d", "http://a.com", "http://c.org/"], rules)


def test_no_rules_no_pages(spark):
    check(spark, URLS, [])
    check(spark, [], url_filters.RULES)


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "http://a.com/de/")], "page_id long, url string")
    plan = url_filters.judged(pages, url_filters.rule_table(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_long_hosts(spark):
    many = ".".join(["a"] * 12_000)
    check(spark, [f"http://{many}.example.org/es/", f"http://{many}/x", "http://..org/", "http://./", "http://org./"], url_filters.RULES)
    check(spark, ["http://x.a.b.c/d", "http://b.c/d", "http://a.b.c/"], [("a.b.c", "/", "block"), ("c", "/d", "allow"), (".c", "/", "block")])
