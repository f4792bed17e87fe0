from __future__ import annotations

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from percepta.llm import urlfilter
from percepta.llm.urlfilter import DOMAIN_RULES, PATTERN_RULES
from tests.llm.conftest import as_strings


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url[url.index("://") + 3 :]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = []
    for verdict, rule in DOMAIN_RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(rule), rule, verdict))
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    found = []
    for k, (verdict, pattern) in enumerate(PATTERN_RULES):
        inside = pattern.strip("^").replace("^", "[^A-Za-z0-9]").replace("*", ".*")
        if re.search(f"(?s)(?<![A-Za-z0-9]){inside}(?![A-Za-z0-9])", host + path):
            found.append((len(pattern), -k, verdict))
    return host, path, None, max(found)[2] if found else "allow"


URLS = [
    None, "", "no scheme", "http://", "http://net", "http://net/", "http://a.example.net/en/x?y", "http://EXAMPLE.net/EN/",
    "https://example.com/de/", "http://xexample.com/de/", "http://a.org/fr/x#y", "http://a.org?x/fr/", "http://org/fr",
    "http://x.com/fr/casino/", "http://casino-win.example.com/", "http://mycasino.com/", "ftp://ADS.x.com/a",
    "http://x.com/CASINO/", "http://a//b://c/net/", "http://x.net:80/", "http://é.net/ü", "http://poker", "a://b.net\n/x/",
    "http://x.com/" + "a/" * 20_000 + "spam", "http://x.com/free-money", "http://free.x.com/money/", "http://x.com/freemoney",
    "http://x.com/spam-filter/", "http://x.com/filter-spam/", "http://x.com/casino/casino-help?x", "http://free.x.com/a\nb/cash",
    "http://win.com/spam-support/prize", "http://x.com/free--gift", "http://free-gift.com/hot/prize/online/cash", "http://money.free.com",
]


def judge(spark, urls):
    pages = spark.createDataFrame([(k, u, "x", "clash") for k, u in enumerate(urls)], "page_id long, url string, html string, verdict string")
    rows = urlfilter.url_report(pages).collect()
    return [(r.host, r.path, r.rule, r.verdict) for r in sorted(rows, key=lambda r: r.page_id)]


def test_urls_equal_brute_force(spark):
    assert judge(spark, URLS + URLS) == [brute(u) for u in URLS + URLS]


def test_empty_table(spark):
    assert judge(spark, []) == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("net org example com . / en fr de casino help free cash A ? - ://".split()), max_size=14).map("".join))
def test_index_equals_brute_force(url):
    domains = urlfilter.RuleIndex([urlfilter.domain_rule(*r) for r in DOMAIN_RULES], {})
    patterns = urlfilter.RuleIndex([urlfilter.pattern_rule(*r) for r in PATTERN_RULES], {})
    host, path = urlfilter.split_url(url)
    found = domains.best(host + path)
    other = patterns.best(host + path)
    decided = found or other
    assert (host, path, found and found.text, decided.verdict if decided else "allow") == brute(url)


def test_rules_without_whole_tokens_and_with_runs():
    rules = [urlfilter.pattern_rule("block", t) for t in ("*track*pixel*", "^ad^*^id^", "/x*y")]
    assert rules[0].tokens == () and rules[1].tokens == ("ad", "id") and rules[2].tokens == ()
    index = urlfilter.RuleIndex(rules, {"ad": 5, "id": 1})
    assert list(index.by_token) == ["id"] and len(index.always) == 2
    assert index.best("h.com/mytrackingpixel.gif").text == "*track*pixel*"
    assert index.best("ad.com/z/id").text == "^ad^*^id^"
    assert index.best("bad.com/z/id") is None
    assert index.best("h.com/x12y").text == "/x*y"


def test_rule_without_path_fits_subdomains():
    index = urlfilter.RuleIndex([urlfilter.domain_rule("block", "spam.com")], {})
    assert index.best("spam.com") and index.best("a.spam.com/x") and not index.best("spam.community/")


def test_malformed_bytes_and_clashing_columns(spark):
    urls = [b"http://a\xff.net/x\xe3\x81", b"http://x.com/\xff/casino/", b"\xff", b"http://\xc3 \xa9/"]
    schema = "page_id long, url binary, __row string, host string, path string, rule string, __text string"
    pages = as_strings(spark, [(k, u, *["clash"] * 5) for k, u in enumerate(urls)], schema, "url")
    out = urlfilter.judge_urls(pages).collect()
    got = {r["__row"].page_id: (r.host, r.path, r.rule, r.verdict) for r in out}
    assert got == {k: brute(u.decode("utf-8", "replace")) for k, u in enumerate(urls)}
    assert all(r["__row"].host == "clash" for r in out)


def test_only_rules_of_the_rarest_token_run(spark):
    """A common token fetches no rule that holds a rarer one."""
    rules = [urlfilter.pattern_rule(*r) for r in PATTERN_RULES]
    urls = [f"http://free{k}.free.com/win/hot/page" for k in range(300)] + ["http://free.com/x/money", "http://a.com/ads"]
    pages = spark.createDataFrame([(u,) for u in urls], "url string")
    tokens = {t for r in rules for t in r.tokens}
    counts = urlfilter.token_counts(pages.selectExpr("CAST(url AS binary) AS __text"), tokens)
    assert counts == {"free": 301, "win": 300, "hot": 300, "money": 1, "ads": 1}
    index = urlfilter.RuleIndex(rules, counts)
    runs = {u: len(index.candidates("".join(urlfilter.split_url(u)))) for u in urls}
    # Rules with money are filed there, but for those with a lure that no url holds.
    assert runs.pop("http://free.com/x/money") == 2 * 3
    assert runs.pop("http://a.com/ads") == 1
    assert set(runs.values()) == {0}
    assert index.best("free.com/x/money").text == "^free^*^money^"
    # Every rule is filed once, under a token of its own.
    filed = [(t, e[2]) for t, entries in index.by_token.items() for e in entries]
    assert len(filed) == len(rules) and not index.always and all(t in r.tokens for t, r in filed)


def test_sql_on_odd_urls():
    import duckdb

    from percepta.llm.queries import ORACLE_SQL

    con = duckdb.connect()
    con.execute("CREATE TABLE pages(page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", list(enumerate(URLS)))
    got = con.execute(f"SELECT page_id, host, path, rule, verdict FROM ({ORACLE_SQL['op5_url_rules']}) ORDER BY 1").fetchall()
    assert [tuple(r[1:]) for r in got] == [brute(u) for u in URLS]
