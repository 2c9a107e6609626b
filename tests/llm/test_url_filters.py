"""URL verdicts against a plain rule check, and cascades against their key sets."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from compare import compare  # noqa: E402

from tallyloom.llm.oracles import ORACLES  # noqa: E402
from tallyloom.llm.queries import QUERIES, URL_RULES  # noqa: E402
from tallyloom.llm.url_filters import Rule, build_cascade, judge_urls  # noqa: E402


def plain(url, rules=URL_RULES):
    at = (url or "").find("://")
    rest = url[at + 3 :] if at >= 0 else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.key), default=None)
    return host, path, best.key if best else None, best.verdict if best else "allow"


URLS = [
    None, "", "no scheme", "http://", "http://net/", "HTTP://A.NET/x", "http://net", "http://a.example.net/en/1", "http://example.net/en", "http://xexample.net/en/",
    "http://example.com/de/?q=/en/", "http://b.example.com/de/x#y", "http://example.com/DE/", "ftp://o.org/fr/", "http://org/fr/a", "http://a.org?fr/", "http://a.net#/", "http://u@a.net:80/",
    "x://y.net/http://example.net/en/", "http://ÄB.net/ü", "http://a..net/", "http://.net/", "http://a\nb.net/c\nd",
]


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "7", "8") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")


def test_whole_table_against_sql(spark, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet'")
    assert compare(QUERIES["op6_url_filters"](spark, folder), con, ORACLES["op6_url_filters"]) is None


def test_odd_urls(spark):
    urls = URLS * 2
    got = judge_urls(pages(spark, urls), URL_RULES).orderBy("page_id").collect()
    assert [tuple(r)[1:] for r in got] == [plain(u) for u in urls]


def test_many_rules_and_no_rules(spark):
    rules = [Rule.parse(f"h{i}.net/{'p/' * (i % 3)}", "block" if i % 2 else "allow") for i in range(300)]
    urls = [f"http://w{i}.h{i}.net/p/q" for i in range(600)] + URLS
    got = judge_urls(pages(spark, urls), rules).orderBy("page_id").collect()
    assert [tuple(r)[1:] for r in got] == [plain(u, rules) for u in urls]
    assert {r.verdict for r in judge_urls(pages(spark, urls), []).collect()} == {"allow"}


def test_cascade_is_exact_over_its_universe(spark):
    listed = {f"k{i}" for i in range(0, 3000, 30)}
    universe = spark.range(20_000).selectExpr("concat('k', id) AS key")
    cascade = build_cascade(listed, universe)
    assert len(cascade.levels) > 1
    assert {f"k{i}" for i in range(20_000) if f"k{i}" in cascade} == listed
    assert sum(len(level.bits) for level in cascade.levels) < 20 * len(listed)


def test_empty_table_and_contradiction(spark):
    assert judge_urls(spark.createDataFrame([], "page_id long, url string"), URL_RULES).count() == 0
    with pytest.raises(ValueError):
        judge_urls(pages(spark, URLS), [Rule.parse("a/", "block"), Rule.parse("a/", "allow")])
