import pytest

from textloom.llm.urls import UrlTrie, judge_urls

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/e")]


def brute(host, path):
    fit = [(len(h.split(".")), len(p), v == "block", h + p, v) for v, h, p in RULES
           if ("." + host).endswith("." + h) and path.startswith(p)]
    return max(fit)[3:] if fit else None


@pytest.mark.parametrize("host", ["com", "example.com", "a.example.com", "www.example.com", "xexample.com", "net", "a.net", "", "org"])
@pytest.mark.parametrize("path", ["", "/", "/en", "/en/", "/en/1", "/es", "/de//", "en/"])
def test_longest_match(host, path):
    assert UrlTrie(RULES).match(host, path) == brute(host, path)


def test_block_holds_at_the_same_place():
    assert UrlTrie([("block", "a", "/"), ("allow", "a", "/")]).match("a", "/x") == ("a/", "block")


def test_frame(spark):
    urls = [(1, "HTTP://WWW.Example.com/en/1?q=/x#y"), (2, None), (3, "no scheme"), (4, "x://y://com/z"), (5, "http://a.net?x"),
            (5, "http://a.net?x"), (6, "http://É.com/#"), (7, "")]
    df = spark.createDataFrame(urls, "page_id long, url string").selectExpr("*", "'z' AS host")
    got = {r["page_id"]: tuple(r)[1:] for r in judge_urls(df, RULES).collect()}
    assert got == {
        1: ("www.example.com", "/en/1", "www.example.com/en/", "allow"), 2: ("", "", None, "allow"), 3: ("", "", None, "allow"),
        4: ("y:", "//com/z", None, "allow"), 5: ("a.net", "", None, "allow"), 6: ("É.com", "/", "com/", "allow"),
        7: ("", "", None, "allow")}
    assert judge_urls(df, RULES).count() == 8 and judge_urls(df.limit(0), RULES).count() == 0
    assert judge_urls(df, [], default="block").where("verdict = 'block'").count() == 8
