import pytest

from railmill.llm.url_filter import Rule, UrlTrie, judge_urls

RULES = [
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("example.org", "/en/12/x", "allow"),
    Rule("com", "", "block"),
    Rule("a.com", "/p", "allow"),
]


def brute(host, path):
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: (len(r.text), len(r.host)), default=None)


@pytest.mark.parametrize("host", ["org", "example.org", "www.example.org", "notexample.org", "com", "a.com", "b.a.com", "net", "", "."])
@pytest.mark.parametrize("path", ["", "/", "/es", "/es/", "/es/1", "/en/1", "/en/12", "/en/12/x", "/en/12/xy/z", "/en/2", "/p", "//", "/pq"])
def test_trie_equals_brute_force(host, path):
    assert UrlTrie(RULES).find(host, path) == brute(host, path)


def test_odd_urls(spark):
    rows = [
        (1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "http://EXAMPLE.org/ES/"), (6, "x://example.org/es/?q"),
        (7, "http://example.org?x=/es/"), (8, "a://b.org://c.com/"), (9, "http://Ä.ORG/#f"), (9, "http://Ä.ORG/#f"), (None, "http://a.com/pq"),
    ]
    pages = spark.createDataFrame(rows, "page_id int, url string").selectExpr("*", "'mine' as rule", "7 as other")
    got = judge_urls(pages, RULES)
    assert got.columns == ["page_id", "url", "other", "host", "path", "rule", "verdict"]
    found = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got.collect()]
    assert sorted(found, key=repr) == sorted(
        [
            (None, "a.com", "/pq", "a.com/p", "allow"), (1, "", "", None, "allow"), (2, "", "", None, "allow"),
            (3, "", "", None, "allow"), (4, "", "", None, "allow"), (5, "example.org", "/ES/", "org/", "allow"),
            (6, "example.org", "/es/", "example.org/es/", "block"), (7, "example.org", "", None, "allow"),
            (8, "b.org:", "//c.com/", None, "allow"), (9, "Ä.org", "/", "org/", "allow"), (9, "Ä.org", "/", "org/", "allow"),
        ],
        key=repr,
    )


def test_no_rules_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id int, url string")
    assert [r["verdict"] for r in judge_urls(pages, [], default="block").collect()] == ["block"]
    assert judge_urls(pages.limit(0), RULES).collect() == []


def test_a_column_of_any_name_stays(spark):
    pages = spark.createDataFrame([(1, "http://www.org/x", "a", "b")], "page_id long, url string, _judged string, __judged string")
    got = judge_urls(pages, RULES).first()
    assert (got["_judged"], got["__judged"], got["verdict"]) == ("a", "b", "allow")
