import random

from tradeloom.llm import url_rules


def plain(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        for i, c in enumerate(rest + "#"):
            if c in "/?#":
                host, rest = rest[:i], rest[i:]
                break
        host = "".join(c.lower() if c.isascii() else c for c in host)
        path = rest.split("?")[0].split("#")[0]
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0])), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else default


URLS = [
    None, "", "no scheme", "http://", "http:///x", "https://WWW.Example.COM/en/a?x=1#y", "https://www.example.com/en",
    "http://example.com/en/", "http://a.net/es/", "http://net/fr/x", "http://a.net?/fr/", "http://.com/", "x://y://com/",
    "http://münchen.com/é", "http://com", "http://com/", "http://a.b.c.d.com/" + "p" * 5000, "http://example.com:80/en/",
]
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def check(spark, urls, rules):
    rows = [(i % 50, u, "x") for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string").repartition(3)
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = sorted(map(tuple, url_rules.judge(pages, table).collect()), key=str)
    assert got == sorted(((i, *plain(u, rules)) for i, u, _ in rows), key=str)


def test_verdicts_are_those_of_a_plain_search(spark):
    check(spark, [*URLS, *URLS], RULES)
    rng = random.Random(8)
    labels, steps = ["a", "b", "ab", "com"], ["x", "y", "xy"]

    def host():
        return ".".join(rng.choice(labels) for _ in range(rng.randint(1, 4)))

    def path():
        return "".join("/" + rng.choice(steps) for _ in range(rng.randint(0, 3)))

    rules = {(host(), path()): rng.choice(["allow", "block"]) for _ in range(60)}
    check(spark, [f"http://{host()}{path()}" for _ in range(400)], [(*k, v) for k, v in rules.items()])


def test_no_rules_no_pages_and_equal_rules(spark):
    check(spark, URLS, [])
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    rules = spark.createDataFrame([("com", "/", "block"), ("com", "/", "allow"), (None, "/", "block"), ("com", None, "block")], "host string, path string, verdict string")
    assert url_rules.judge(pages, rules).first().verdict == "allow"
    assert url_rules.judge(pages.where("page_id > 1"), rules).count() == 0
