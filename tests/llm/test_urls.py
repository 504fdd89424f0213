import random

from flowlab.llm import urls

RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]


def brute(url, rules=RULES):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    n = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:n])
    path = rest[n:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[2:] if fits else (None, "allow")))


def test_rules_against_brute_force(spark):
    rng = random.Random(5)
    hosts = ["com", "example.com", "Sub.Example.COM", "xexample.com", "a.b.net", "example.net", "org", "org.", "É.org", "", "u@com:80"]
    paths = ["", "/", "/en/", "/en/7", "/en/71/x", "/EN/7", "/de/8", "/de/9?x=/en/7", "/es/#q", "?a=/en/", "/en", "//en/"]
    given = [f"{rng.choice(['http', 'ftp'])}://{h}{p}" for h in hosts for p in paths] + [None, "", "no scheme", "http:/com/en/", "x://y://com/en/", "http://com/en/" + "z" * 50_000]
    rows = list(enumerate(given)) + [(1, given[1]), (None, given[14])]
    df = spark.createDataFrame(rows, "page_id bigint, url string")
    got = urls.judge_urls(df, spark.createDataFrame(RULES, "host string, path string, verdict string")).collect()
    assert len(got) == len(rows)
    assert sorted(map(repr, ((r["page_id"], r["url"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got))) == sorted(repr((i, u, *brute(u))) for i, u in rows)


def test_shuffled_rules_ties_and_clashes(spark, monkeypatch):
    monkeypatch.setattr(urls, "BROADCAST_RULES", 1)
    rules = spark.createDataFrame([("com", "/a", "allow"), ("com", "/a", "block"), (None, "/a", "block"), ("a.com", None, "allow")], "host string, path string, verdict string")
    df = spark.createDataFrame([("http://com/a", "mine", 1), ("http://b.a.com/a", "mine", 2)], "url string, host string, u_url int")
    got = sorted(map(tuple, urls.judge_urls(df, rules).select("url", "u_url", "host", "rule", "verdict").collect()))
    # a.com (5 characters) and com/a (5): equally long, the longer host wins
    assert got == [("http://b.a.com/a", 2, "b.a.com", "a.com", "allow"), ("http://com/a", 1, "com", "com/a", "block")]


def test_empty_tables(spark):
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    df = spark.createDataFrame([("http://com/a",)], "url string")
    assert [tuple(r) for r in urls.judge_urls(df, rules).collect()] == [("http://com/a", "com", "/a", None, "allow")]
    assert urls.judge_urls(df.limit(0), spark.createDataFrame(RULES, "host string, path string, verdict string")).collect() == []
