"""URL filter: rule index, host rules, edges."""
from clickflow.llm import url_filter as uf


def test_literal_tokens_are_certain():
    assert uf.literal_tokens(r"[/.-]spam[.-]") == {"spam"}
    assert uf.literal_tokens(r"[/.-]casino[s]?[.-]") == set()      # may go on with an s
    assert uf.literal_tokens(r"/ads/(?:a|b)/track/") == {"ads", "track"}
    assert uf.literal_tokens(r"spam") == set()                     # may be part of a longer run
    assert uf.HostRule("block", "example.com", "/en").tokens() == {"example", "com"}


def test_rules_go_under_their_rarest_token():
    by_token, always = uf.index_rules([uf.HostRule("block", "example.com", "/"), uf.PatternRule("block", "x+")],
                                      {"example": 3, "com": 90})
    assert list(by_token) == ["example"] and len(always) == 1


def naive(url, host_rules, pattern_rules):
    host, path = uf.split_url(url)
    fits = [r for r in host_rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fits:
        best = max(fits, key=lambda r: len(r.name))
        return host, path, best.name, best.verdict
    import re
    low = (url or "").translate(uf.LOWER)
    return host, path, None, "block" if any(re.search(r.regex, low) for r in pattern_rules) else "allow"


def test_judging_with_edges(spark):
    urls = ["http://www.example.com/en/1", "https://Example.COM/en/x?y#z", "http://a.example.com/fr/", "http://b.net/es/q",
            "http://net/fr/", "http://xnet/fr/", "ftp://spam.farm.org/", "http://a.casino.org/x", "no scheme", "", None,
            "http://example.com", "http://example.com?x=/en/", "a://b://c.com/", "http://example.com/" + "en/" * 20000,
            "http://www.example.com/en/1"]
    df = spark.createDataFrame([(i if i != 3 else None, u, "x", "y") for i, u in enumerate(urls)],
                               "page_id long, url string, host string, verdict string")
    got = uf.filter_urls(df).collect()
    assert len(got) == len(urls)
    want = sorted(((i if i != 3 else None, *naive(u, uf.HOST_RULES, uf.PATTERN_RULES)) for i, u in enumerate(urls)), key=repr)
    assert sorted(map(tuple, got), key=repr) == want
    assert uf.filter_urls(df.limit(0)).count() == 0
    assert {r.verdict for r in uf.filter_urls(df, host_rules=(), pattern_rules=()).collect()} == {"allow"}
