import re

from dimflow.llm import urls
from dimflow.llm.queries import URL_RULES

ODD = [None, "", "example.com/en/x", "://", "http://", "http://COM/", "http://com", "https://WWW.Example.COM/en/", "http://example.com/en",
       "http://example.com/en/?a#b", "http://notexample.com/en/", "http://x.example.com/en/casino-win", "http://a.net/es/porn",
       "http://a.org?porn", "http://a.org/#xxx", "http://a.org/pornography", "http://a.org/Cheap/cheap-cheap", "http://a.org/cheap_pills",
       "http://a.org/cheap9/pills", "http://a.org/ÉcasinoÉwin/", "ftp://user:pw@Host.org:80/p?u=http://b.net/es/", "warez",
       "http://a.net/es", "http://a.net/fr/" + "y" * 50_000 + "-xxx", "http://com./x", "http://.com/x", "a://b://c.com/x"]


def brute(url, vocabulary=urls.VOCABULARY, rules=URL_RULES):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in url or "")
    rest = (url or "")[(url or "").index("://") + 3:] if "://" in (url or "") else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host):])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if ("." + host).endswith("." + r.host) and path.startswith(r.path)]
    rule = max(fits, key=lambda r: len(str(r)), default=None)
    hits = {t for t in vocabulary if re.search(f"(?<![a-z0-9]){re.escape(t)}(?![a-z0-9])", lower)}
    strict = sum(vocabulary[t] >= 2 for t in hits)
    own = "block" if strict or len(hits) >= 2 else "allow"
    return host, path, rule and str(rule), rule.verdict if rule else own, strict, len(hits) - strict, sorted(hits)


def test_odd_urls_as_by_brute_force(spark):
    rows = [(i if i % 5 else None, u, "x", "y") for i, u in enumerate(ODD * 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string").repartition(3)
    found = urls.judged(pages, urls.UrlFilter(URL_RULES))
    assert found.columns == ["page_id", "host", "path", "rule", "verdict", "n_strict", "n_soft", "hits"]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(str((r[0], *brute(r[1]))) for r in rows)


def test_verdicts():
    verdict = lambda u: urls.UrlFilter(URL_RULES).judge([u]).verdict[0]
    assert verdict("http://a.org/cheap/cheap") == "allow"  # one soft term, twice
    assert verdict("http://a.org/cheap/pills") == "block"
    assert verdict("http://a.org/xxx") == "block"
    assert verdict("http://a.com/xxx") == "allow"  # a rule decides first
    assert verdict("http://www.example.com/en/") == "allow"
    assert verdict("http://m.example.com/en/") == "block"


def test_longest_rule_wins_and_ties_go_to_the_longer_host():
    rules = (urls.Rule("allow", "b.c", "/dd"), urls.Rule("block", "a.b.c", "/"), urls.Rule("block", "c", "/ddd"))
    assert urls.UrlFilter(rules).judge(["x://a.b.c/dddd"]).rule[0] == "a.b.c/"
    assert urls.UrlFilter(rules).judge(["x://z.b.c/dddd"]).rule[0] == "b.c/dd"


def test_empty_tables_rules_and_vocabulary(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert urls.judged(none, urls.UrlFilter(URL_RULES)).count() == 0
    one = spark.createDataFrame([(1, "http://a.com/xxx")], "page_id long, url string")
    assert urls.judged(one, urls.UrlFilter((), {})).first().verdict == "allow"


def test_one_pass_over_two_columns(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plan = urls.judged(pages, urls.UrlFilter(URL_RULES))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "html" not in plan
