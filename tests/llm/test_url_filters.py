import random
import re

from stratamart.llm import url_filters as U
from tests.compare import compare, connect

BASE = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), re.match("[^?#]*", rest[len(host):])[0]


def brute(url):
    host, path = parts(url)
    fits = [(len(h + p), h + p, v) for h, p, v in BASE if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        _, rule, verdict = max(fits)
        return host, path, rule, verdict
    hits = [r for r in U.PATTERN_RULES if re.search(r.pattern, url or "")]
    return host, path, None, max(hits, key=lambda r: (r.priority, r.name)).verdict if hits else "allow"


def urls():
    dice = random.Random(2)
    out = [None, "", "http://", "://net/", "net/", "https://a.net", "https://a.net/", "https://NET/x", "http://xnet/", "http://a.net:80/",
           "http://example.net/en/", "http://w.Example.NET/en/a?x=http://b.org/fr/", "http://example.net/EN/", "http://example.net/en",
           "http://u@example.com/de/", "http://example.com/de/#x", "http://example.com?/de/", "http://a.org/fr/é", "http://a.org/fr",
           "x://y://net/", "a?b://net/", "a#b://c.org/fr/d", "http://a\n.net/", "http://a.net/\n", "http://ads.example.com/", "http://xads.com/ads/",
           "http://x.com/a/ads/b", "http://casino-win.com/", "http://CASINO.com/", "http://spam-farm.com/robots.txt", "http://pornx.com", "http://x-porn-y.com",
           "http://" + "a." * 5000 + "net/", "http://x.com/" + "ads/" * 3000]
    for _ in range(300):
        host = ".".join(dice.choice(["www", "example", "ads", "track", "casino", "ad-x", "m", "Spam"]) for _ in range(dice.randint(0, 2)))
        out.append(dice.choice(["http", "https", "HTTP"]) + "://" + host + dice.choice([".", ""]) + dice.choice(["example.net", "example.com", "org", "net", "x.org"])
                   + dice.choice(["/", "", "/en/", "/de/", "/fr/", "/en", "/ads/"]) + dice.choice(["", "a", "?q=/en/", "#net/"]))
    return out


def test_equals_brute_force(spark):
    rows = [(i, u, "x", "y") for i, u in enumerate(urls())] + [(5, "http://a.net/", "x", "y")] * 300 + [(None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string").repartition(4)
    out = U.judge_urls(pages)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict", "priority"]
    base = {h + p for h, p, _ in BASE}
    got = sorted(((r.page_id, r.host, r.path, r.rule if r.rule in base else None, r.verdict) for r in out.collect()), key=repr)
    assert got == sorted(((i, *brute(u)) for i, u, _, _ in rows), key=repr)


def test_rarest_token(spark):
    frame = spark.createDataFrame([("http://a.example.net/en/x",), ("http://b.net/",), ("http://example.com/en/",)], "url string")
    filed = {r.rule: r.token for r in U.rule_index(spark, frame, U.BASE_RULES + U.PATTERN_RULES).collect()}
    # No url holds "fr" or "org"; ties go to the smaller token.
    assert filed["org/fr/"] == "fr" and filed["net/"] == "net" and filed["example.com/de/"] == "de" and filed["adult-xxx"] == "xxx" and "" not in filed.values()


def test_query_equals_sql_without_python(spark):
    folder = "/root/testdata/sf0.01"
    assert compare(spark, connect(folder), "op8", U.op8_url_filters, U.SQL, folder) is None
    plan = U.op8_url_filters(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_empty(spark):
    assert U.judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0
