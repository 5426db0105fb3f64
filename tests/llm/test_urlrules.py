from __future__ import annotations

import random

from pyspark.sql import functions as F

from indexday.llm.urlrules import judge

RULES = "host string, path string, verdict string"


def plain(url, rules, default="allow"):
    """Every rule tried on the URL."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([i for i, c in enumerate(rest) if c in "/?#"], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        rest = rest[cut:]
        path = rest[: min([i for i, c in enumerate(rest) if c in "?#"], default=len(rest))]
    fits = [
        (len(h + p), len(h), h + p, v)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if not fits:
        return host, path, None, default
    return host, path, max(fits)[2], max(fits)[3]


def judged(spark, urls, rules, **more):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    pages = pages.withColumn("host", F.lit("a clash")).withColumn("rule", F.lit(1)).withColumn("row", F.lit(2))
    found = judge(pages.repartition(3), spark.createDataFrame(rules, RULES), **more).collect()
    assert sorted(r["page_id"] for r in found) == list(range(len(urls)))
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in found}


def test_rules_by_brute_force(spark):
    rnd = random.Random(12)
    labels, steps = ["a", "b", "ab", "é", "x", ""], ["", "a", "ab", "b", "\U0010ffff", "é"]

    def some_host():
        return ".".join(rnd.choice(labels) for _ in range(rnd.randint(1, 4)))

    def some_path():
        return "".join(rnd.choice(["/", ""]) + rnd.choice(steps) for _ in range(rnd.randint(0, 4)))

    rules = {(h, p): rnd.choice(["allow", "block"]) for h, p in ((some_host(), some_path()) for _ in range(300)) if h}
    rules = [(h, p, v) for (h, p), v in rules.items()]
    ends = ["", "?q=/a", "#/b", "?a#b"]
    urls = [f"{rnd.choice(['http', 'HTTPS', ''])}://{some_host()}/{some_path()}{rnd.choice(ends)}" for _ in range(1500)]
    got = judged(spark, urls, rules)
    for i, url in enumerate(urls):
        assert got[i] == plain(url, rules), url
    assert sum(g[2] is not None for g in got.values()) > 500


def test_longest_rule_wins_and_verdicts_follow(spark):
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("EXAMPLE.org", "/es/ok", "allow"), ("org", "", "block"),
             ("twice.net", "/", "allow"), ("twice.net", "/", "block"), ("", "/", "block"), (None, "/", "block"), ("none.net", "/", None),
             ("bare.net", None, "block")]
    cases = {
        "http://www.example.org/es/1": ("www.example.org", "/es/1", "example.org/es/", "block"),
        "http://Example.ORG/es/ok?x": ("example.org", "/es/ok", "example.org/es/ok", "allow"),
        "http://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
        "http://example.org": ("example.org", "", "org", "block"),
        "http://example.org?a=/es/": ("example.org", "", "org", "block"),
        "http://example.org:80/es/": ("example.org:80", "/es/", None, "allow"),
        "http://twice.net/": ("twice.net", "/", "twice.net/", "block"),
        "http://none.net/": ("none.net", "/", None, "allow"),
        "http://a.bare.net": ("a.bare.net", "", "bare.net", "block"),
        "http:///es/": ("", "/es/", None, "allow"),
        "://org/x": ("org", "/x", "org/", "allow"),
        "http://a/b://org/": ("a", "/b://org/", None, "allow"),
        "http://x.org/a\nb": ("x.org", "/a\nb", "org/", "allow"),
        "no scheme.org/": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
    }
    got = judged(spark, [*cases, None], rules)
    assert [got[i] for i in range(len(cases))] == list(cases.values())
    assert got[len(cases)] == ("", "", None, "allow")


def test_hot_and_long_urls(spark):
    rules = [("org", "/a/", "block"), ("b.org", "/a/b", "allow")]
    urls = ["http://b.org/a/b/c"] * 3000 + ["http://" + "l." * 3000 + "org/a/" + "x" * 50_000] + ["http://b.org/a/" + "y" * 9] * 500
    got = judged(spark, urls, rules)
    assert {got[i][2:] for i in range(3000)} == {("b.org/a/b", "allow")}
    assert {got[i][2:] for i in range(3000, 3501)} == {("org/a/", "block")}


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a/"), (1, "http://a/"), (None, "http://b/")], "page_id long, url string")
    none = spark.createDataFrame([], RULES)
    got = judge(pages, none, default="block").collect()
    assert sorted(str(tuple(r)) for r in got) == ["(1, 'a', '/', None, 'block')"] * 2 + ["(None, 'b', '/', None, 'block')"]
    assert judge(pages.limit(0), spark.createDataFrame([("a", "/", "block")], RULES)).collect() == []


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "http://a/")], "page_id long, url string")
    rules = spark.sql("SELECT 'a' AS host, '/' AS path, 'block' AS verdict")
    plan = judge(pages, rules)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
