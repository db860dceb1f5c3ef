import pytest

from veritab.llm import url_filter

URLS = ["https://a.example.com/en/1", "https://WWW.Example.com/en/x?q#f", "http://example.com", "http://example.com/", None, "",
        "no scheme.com/en/", "ftp://x.net/es/1", "ftp://x.net/ES/1", "http://net/fr/", "http://notnet/fr/", "http://a.b.net?x=/es/",
        "http://www.example.com/en/://b.net/es/", "http://example.com:80/en/", "http://.com/a"]


def brute(url, rules, default="allow"):
    at = (url or "").find("://")
    rest = url[at + 3:] if at >= 0 else ""
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min((path.find(c) for c in "?#" if c in path), default=len(path))]
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, default))
    return host, path, best[1], best[2]


@pytest.mark.parametrize("rules", [url_filter.RULES, [("example.com", "/en", "block"), ("a.example.com", "", "allow"), ("b", "/", "block")]])
def test_equals_brute_force(spark, rules):
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS)] + [(0, URLS[0], "h"), (None, URLS[1], None)],
                                  "page_id long, url string, html string").withColumn("host", url_filter.F.lit("clash"))
    got = url_filter.judge_urls(pages, url_filter.rule_table(spark, rules)).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        url = URLS[1] if r.page_id is None else URLS[r.page_id]
        assert (r.host, r.path, r.rule, r.verdict) == brute(url, rules)


def test_index_takes_the_rarest_token(spark):
    urls = spark.createDataFrame([(f"http://h{i}.example.com/en/{i}",) for i in range(5)] + [("http://example.com/rare/",)], "url string")
    pages = url_filter.with_parts(urls)
    rules = url_filter._compiled(url_filter.rule_table(spark, [("example.com", "/rare/x", "block"), ("", "", "allow")]))
    index = {r.rule: r.token for r in url_filter.rule_index(url_filter._url_tokens(pages), rules).collect()}
    assert index == {"example.com/rare/x": "p:rare", "": ""}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    rules = url_filter.rule_table(spark, url_filter.RULES)
    assert url_filter.judge_urls(none, rules).count() == 0
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert url_filter.judge_urls(pages, rules.limit(0)).first().verdict == "allow"
