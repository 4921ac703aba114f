import random
import re

from helpers import rows_of

from hopdex.llm.url_rules import HOST_RULES, PATTERN_RULES, judge_urls, rule_regex, rule_tokens


def brute(url):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in url or "")
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group() if rest[len(host):len(host) + 1] == "/" else ""
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule, verdict in HOST_RULES:
        name, start = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            if best is None or len(rule) > len(best[0]):
                best = rule, verdict
    if best:
        return host, path, *best
    hits = {v for p, v in PATTERN_RULES if url is not None and re.search(rule_regex(p), low)}
    return host, path, None, "allow" if "allow" in hits or not hits else "block"


def urls():
    rng = random.Random(6)
    hosts = ["example.org", "EXAMPLE.org", "a.b.example.net", "www.x.example.com", "m.y.net", "blog.z.example.net", "com",
             "spam-farm.net", "notspam-farm.net", "cheap-pills.net", "x.cheap-pills.example.net", "org", "É.com", ""]
    paths = ["", "/", "/en/12", "/es/", "/en/1", "/fr/x", "/de/x.html", "/casino/1", "/casino", "/xcasino", "/login", "/en/a.html",
             "/track/a/pixel", "?utm_source=feed", "/x?utm_source=feed&a=1", "/q?page=2&ref=z", "/q?page=2", "#a/b", "/a?b://c/d"]
    out = [f"{rng.choice(['http', 'https', 'HTTP'])}://{h}{p}" for h in hosts for p in paths]
    return out + [None, "", "no scheme", "://", "http://", "mailto:a@casino.org", "x://y://z/casino/", "http://a\nb.net/login"]


def test_matches_brute_force(spark):
    rows = [(i, u) for i, u in enumerate(urls())] + [(5, "http://q.net/login")] * 3 + [(None, "http://q.net/casino/")]
    pages = spark.createDataFrame([(i, u, "x", "y", 1) for i, u in rows],
                                  "page_id long, url string, host string, token string, verdict int").repartition(3)
    found = rows_of(judge_urls(pages), "page_id", "host", "path", "rule", "verdict")
    assert found == sorted(((i, *brute(u)) for i, u in rows), key=repr)
    assert {r[4] for r in found} == {"allow", "block"}


def test_every_matching_url_has_the_tokens():
    for pattern, _ in PATTERN_RULES:
        for url in urls():
            if url and re.search(rule_regex(pattern), url.lower()):
                assert set(rule_tokens(pattern)) <= set(re.split("[^a-z0-9]+", url.lower()))


def test_empty_table(spark):
    assert judge_urls(spark.createDataFrame([], "page_id long, url string")).collect() == []
