from tidemark.llm.registry import URL_RULES
from tidemark.llm.url_filter import judge_urls, rule_table


def judge(spark, urls, rules=URL_RULES):
    pages = spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(urls)],
                                  "page_id long, url string, host string, rule string")
    rows = judge_urls(pages, rule_table(spark, rules)).collect()
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows}


def brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("#")[0].split("?")[0]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[3], max(fits)[4]) if fits else (host, path, None, "allow")


def test_matches_brute_force_on_odd_urls(spark):
    urls = ["http://a.example.org/es/1", "HTTP://A.Example.ORG/en/1x", "https://example.org/en/2", "http://org/",
            "http://org", "http://myexample.org/es/", "http://x.com/fr/", "http://x.com/de/a?b=/fr/", None, "", "x",
            "://", "http://", "http:///path", "http://com?/de/", "http://com#a/de/", "http://y.com/de",
            "http://a://b.com/de/", "http://Ä.com/de/", "http://com:80/de/", "http://u@x.com/de/",
            "http://x.com/" + "d" * 100_000, "http://" + "a." * 5000 + "com/de/", "http://x.com/de/", "http://x.com/de/"]
    got = judge(spark, urls)
    assert got == {i: brute(u, URL_RULES) for i, u in enumerate(urls)}


def test_longest_rule_then_longer_host_then_block(spark):
    rules = [("allow", "b.com", "/x"), ("block", "com", "/xyz"), ("block", "a.b.com", ""), ("allow", "a.b.com", ""),
             ("block", "c.com", "/xy"), ("allow", "com", "/xy/w"), ("block", None, "/"), ("block", "", "/")]
    urls = ["http://b.com/xyzz", "http://a.b.com/q", "http://c.com/xy/w", "http://d.net/"]
    got = judge(spark, urls, rules)
    assert [got[i][2:] for i in range(4)] == [
        brute(u, [r for r in rules if r[1]])[2:] for u in urls]


def test_no_pages_and_no_rules(spark):
    assert judge(spark, []) == {}
    assert judge(spark, ["http://a.org/"], [(None, None, None)]) == {0: ("a.org", "/", None, "allow")}
