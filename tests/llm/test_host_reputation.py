from collections import Counter

from gaugeworks.llm import host_reputation as hr
from gaugeworks.llm import queries
from gaugeworks.llm.common import table


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    path = rest[cut:].split("?")[0].split("#")[0]
    return "".join(c.lower() if c.isascii() else c for c in rest[:cut]), path


def plain_rule(host, path):
    fits = [(h + p, a) for h, p, a in queries.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda r: len(r[0]), default=(None, None))


def check(rows):
    for r in rows:
        host, path = parts(r.url)
        rule, action = plain_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == action if rule else r.verdict in ("allow", "block")


def test_query(spark, sf_small):
    urls = table(spark, sf_small, "pages").select("page_id", "url")
    rows = queries.op3_host_reputation(spark, sf_small).join(urls, "page_id").collect()
    assert len(rows) == urls.count()
    check(rows)


def test_odd_urls(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.COM/en/x", "http://www.example.com/en/", "http://b.net/es/1?x#y", "http://b.net?/es/", "http://com", "http://com/", "x://y://z/p", "http://ÄB.com/q", "http://b.net/es/1?x#y", "http://notcom/"]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, host string")
    rules = spark.createDataFrame(queries.RULES, "host string, path string, action string")
    none = spark.createDataFrame([], "host string, bad boolean")
    rows = hr.judge(pages, none, rules).collect()
    assert len(rows) == len(urls)
    check(rows)
    assert {round(r.share, 6) for r in rows} == {0.5}
    assert hr.judge(pages.limit(0), none, rules).count() == 0
    assert hr.judge(pages, none, rules.limit(0)).where("rule is not null").count() == 0


def test_small_hosts_lean_on_their_domain(spark):
    rows = [("a.bad.com", True)] * 30 + [("b.bad.com", True)] * 28 + [("b.bad.com", False)] * 2 + [("new.bad.com", False)]
    rows += [(f"h{i}.good{i}.com", False) for i in range(20) for _ in range(30)] + [("x.co.uk", None)]
    outcomes = spark.createDataFrame(rows, "host string, bad boolean")
    hosts = spark.createDataFrame([(h,) for h in {r[0] for r in rows} | {"unseen.bad.com", "unseen.org"}], "host string")
    got = {r.host: r for r in hr.reputation(outcomes, hosts).collect()}
    assert got["a.bad.com"].bound > 0.8 and got["h1.good1.com"].share < 0.05
    assert 0.3 < got["unseen.bad.com"].share < 1 and got["new.bad.com"].share < got["unseen.bad.com"].share
    assert got["unseen.org"].n == 0 and got["unseen.org"].bound < got["unseen.org"].share
    assert Counter(r.n for r in got.values())[30] == 22
    names = {r.host: (r.domain, r.suffix) for r in hr.levels(spark.createDataFrame([("a.b.co.uk",), ("b.com:80",), ("com",), ("",)], "host string")).collect()}
    assert names["a.b.co.uk"] == ("b.co.uk", "co.uk") and names["b.com:80"] == ("b.com", "com") and names["com"] == ("com", "com")
