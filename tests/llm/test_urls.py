import re

import pytest

from placeweave.llm.urls import RULES, judge, labelled_urls, train

AWKWARD = [None, "", "no scheme/net/", "://", "http://", "http://A.NET", "http://a.net/", "HTTP://X.Example.NET/en/1?q=/fr/", "ftp://example.net/en", "http://example.net/en/",
           "http://notexample.net/en/", "https://example.com/de/a#b", "https://www.example.com/de", "https://example.com?x=://b.net/", "http://kino.org/fr/1",
           "http://kino.org/FR/1", "x://y://z.net/", "http://ÄÖ.example.NET/\nen/", "http://a.net:80/x", "http://" + "a" * 100_000 + ".net/" + "b" * 100_000]


def rule_of(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]) if m else ""
    path = m[2] if m else ""
    fits = [(len(r), r, v) for r, v in RULES for d, _, p in [r.partition("/")]
            if (host == d or host.endswith("." + d)) and path.startswith("/" + p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


@pytest.fixture(scope="module")
def model(spark):
    return train(labelled_urls(spark))


def test_rules_hosts_and_paths(spark, model):
    pages = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate([*AWKWARD, *AWKWARD])], "page_id long, url string, host string, __probability string")
    got = {r.page_id: r for r in judge(pages, model, keep=("page_id",)).collect()}
    assert len(got) == 2 * len(AWKWARD)
    for i, u in enumerate([*AWKWARD, *AWKWARD]):
        host, path, rule, verdict = rule_of(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == (verdict or ("block" if got[i].score >= 0.5 else "allow"))


def test_unseen_sites_are_told_apart(spark, model):
    unwanted = ["http://m.casino-win.example.com/en/4", "https://free-bets.example.org/fr/2?a=b", "http://cheap-pills.example.com/en/9", "https://adult-x.example.com/es/8",
                "http://www.spam-farm.example.org/en/31", "https://ads-track.example.com/de/5x"]
    wanted = ["http://www.ththon.example.com/en/4", "https://tionble.example.org/de/2?a=b", "http://blog.therly.example.com/en/9", "https://m.city-council.example.com/es/8"]
    pages = spark.createDataFrame([(u,) for u in unwanted + wanted], "url string")
    got = {r.url: r.score for r in judge(pages, model, rules=(), keep=("url",)).collect()}
    assert min(got[u] for u in unwanted) > 0.5 > max(got[u] for u in wanted)


def test_empty_table_and_native_plan(spark, model):
    judged = judge(spark.createDataFrame([], "page_id long, url string"), model, keep=("page_id",))
    assert judged.count() == 0
    plan = judged._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_the_registered_name_counts(spark):
    wanted = ["www.library.com", "m.museum.net", "www.gardens.org", "www.weather.com"]
    unwanted = ["www.casino.com", "m.pills.net", "www.casinos.org", "m.casino-royal.com"]
    rows = [(f"https://{h}/en/{i}",) for i, h in enumerate(wanted + unwanted)]
    got = {r.host: r.verdict for r in judge(spark.createDataFrame(rows, "url string"), train(labelled_urls(spark)), rules=()).collect()}
    assert got == {h: "allow" for h in wanted} | {h: "block" for h in unwanted}
