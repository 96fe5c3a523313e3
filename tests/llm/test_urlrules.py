"""URL rules against a plain loop over all rules, and how candidates are fetched."""

import random
import re

import pytest
from helpers import LOWER

from slotviews.llm import urlrules

PAGES = "page_id bigint, url string, html string, token string, regex string, level int, rule string, n bigint"


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "h", "t", "r", 9, "x", 1) for i, u in enumerate(urls)], PAGES)


def split(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url[url.index("://") + 3 :]
    host, tail = re.match(r"(?s)([^/?#]*)(.*)", rest).groups()
    host = host.translate(LOWER)
    return host, re.match("[^?#]*", tail)[0], "." + host + tail


def regex(pattern, any_case):
    """The meaning of a pattern, written down character by character."""
    out, body = "", pattern
    if body.startswith("||"):
        out, body = r"\A[^/?#]*\.", body[2:]
    elif body.startswith("|"):
        out, body = r"\A\.", body[1:]
    end = body.endswith("|")
    for c in body[:-1] if end else body:
        out += ".*" if c == "*" else r"(?:[^A-Za-z0-9_.%-]|\Z)" if c == "^" else re.escape(c)
    return re.compile(out + (r"\Z" if end else ""), re.S | re.A | (re.I if any_case else 0))


def expected(urls, rules):
    out = []
    for i, url in enumerate(urls):
        host, path, subject = split(url)
        fits = [r for r in rules if subject is not None and r[1] is not None and r[2] is not None and regex(r[1], bool(r[4])).search(subject)]
        best = min(fits, key=lambda r: (-(r[3] or 0), -len(r[1]), r[2], r[1], r[0]), default=None)
        out.append((i, host, path, best and best[0], best[2] if best else "allow"))
    return sorted(out, key=str)


def judged(spark, urls, rules):
    rows = urlrules.judge(pages(spark, urls), spark.createDataFrame(rules, urlrules.RULES))
    return sorted([(r.page_id, r.host, r.path, r.rule, r.verdict) for r in rows.collect()], key=str)


ODD = [
    None, "", "no scheme", "http://", "http:///en/", "https://A.Example.NET/en/1", "x?u=http://net/", "http://net", "http://net/", "http://net?/", "http://internet/", "http://a.net:80/", "http://sub.example.com/DE/",
    "http://example.com/de/#net/", "http://a.org/fr/2", "http://a.org/FR/2", "HTTP://É.net/é\n/b", "http://a.net/" + "x/" * 30_000, "http://ads.b.com/ads/transparency/q", "http://b.com/ads/", "http://bigcasino.com/", "http://casino-win.example.net/en/3",
    "http://net/", "ftp://u:p@host.net/a.exe", "http://a.com/a.exe?x", "http://a.com/feed/x/y/comments", "http://a.com/feed/comments", "http://K.com/K",
]
RULES = [
    ("net/", "||net/", "block", 1, False), ("example.net/en/", "||example.net/en/", "allow", 1, False), ("example.com/de/", "||example.com/de/", "block", 1, False), ("org/fr/", "||org/fr/", "allow", 1, None),
    ("a", "/ads/", "block", 0, True), ("b", "/ads/transparency/", "allow", None, True), ("c", "casino", "block", 0, True), ("d", ".exe|", "block", 0, True), ("e", "/feed/*/comments^", "block", 0, False), ("f", "|k.com/", "block", 0, False),
    ("null", None, "block", 5, False), ("none", "/en/", None, 5, False), ("g", "/never/seen/", "block", 0, False), ("a", "/ads/", "block", 0, True), ("same length", "/sad/", "block", 0, True),
]


def test_odd_urls(spark):
    assert judged(spark, ODD, RULES) == expected(ODD, RULES)


def test_no_rules_and_no_pages(spark):
    assert {r[4] for r in judged(spark, ODD, RULES[-2:])} == {r[4] for r in expected(ODD, RULES[-2:])}
    empty = spark.createDataFrame([], urlrules.RULES)
    assert {r.verdict for r in urlrules.judge(pages(spark, ODD), empty).collect()} == {"allow"}
    assert urlrules.judge(pages(spark, ODD), empty, default="block").filter("verdict = 'block'").count() == len(ODD)
    assert urlrules.judge(pages(spark, ["x"]).limit(0), spark.createDataFrame(RULES, urlrules.RULES)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_random_rules(spark, seed):
    draw = random.Random(seed)
    words = ["a", "ad", "ads", "x-1", "Shop", "net", "org", "de", "%20", "_", "é", "7"]
    marks = ["/", ".", "-", "?", "=", "&", "#", "^", "*", "$", "(", "+", ""]
    text = lambda n, among: "".join(draw.choice(words) + draw.choice(among) for _ in range(draw.randint(1, n)))
    urls = [f"http://{text(3, ['.', '-'])}/{text(5, marks[:7] + ['$', '(', '+'])}" for _ in range(300)]
    urls += urls[:30]
    rules = [(str(i), draw.choice(["||", "|", "", "", ""]) + text(3, marks) + draw.choice(["", "", "|"]), draw.choice(["allow", "block"]), draw.choice([0, 0, 1]), draw.random() < 0.5) for i in range(60)]
    assert judged(spark, urls, rules) == expected(urls, rules)


def test_rules_stand_under_their_rarest_token(spark):
    urls = ["http://a.net/shop/1"] * 5 + ["http://b.net/rare/shop/", "http://c.net/"]
    subjects = spark.createDataFrame([(split(u)[2],) for u in urls], "subject string")
    rules = [("1", "||net/*/shop/", "block", 0, False), ("2", "/rare/shop/", "block", 0, False), ("3", "/shop", "block", 0, False), ("4", "/unseen/shop/", "block", 0, False)]
    rows = urlrules.index(subjects, spark.createDataFrame(rules, urlrules.RULES)).collect()
    assert {r.rule: r.token for r in rows} == {"1": "shop", "2": "rare", "3": urlrules.ANY}


def test_only_candidates_run_expressions(spark):
    urls = [f"http://host{i}.com/page/{i}" for i in range(100)]
    rows = urlrules.judge(pages(spark, urls), spark.createDataFrame([("r", "/page/7|", "block", 0, False)], urlrules.RULES))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
    assert [r.page_id for r in rows.filter("verdict = 'block'").collect()] == [7]
