from __future__ import annotations

import datetime as dt
import random
import re

from pyspark.sql import functions as F

from demandkit.llm import url_filters

DAY = dt.date(2024, 1, 1)
CAPTURES = "page_id long, url string, fetched date"
ENTRIES = "list string, pattern string, dated date, verdict string"


def day(n):
    return None if n is None else DAY + dt.timedelta(n)


def plain(captures, entries):
    out = []
    for page, url, at in captures:
        found = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", url or "")
        host = found[1].lower() if found else ""
        path = (re.match(r"[^/]*//[^/?#]*(/[^?#]*)", url or "") or [0, ""])[1]
        best = None
        for name, pattern in {(e[0], e[1]) for e in entries if e[1] is not None}:
            past = [e for e in entries if e[:2] == (name, pattern) and e[2] is not None and at is not None and e[2] <= at]
            if not past or not host:
                continue
            newest = max(e[2] for e in past)
            verdict = max(e[3] for e in past if e[2] == newest)
            covered = (host + path).startswith(pattern) if "/" in pattern else (
                host == pattern or host.endswith("." + pattern) and "." in pattern)
            if verdict != "none" and covered:
                best = min(filter(None, [best, (-len(pattern), verdict != "allow", name, verdict, pattern, newest)]))
        out.append((page, url, at, *((best[3], best[2], best[4], best[5]) if best else ("none", None, None, None))))
    return sorted(out, key=str)


def test_equals_brute_force(spark):
    rnd = random.Random(6)
    hosts = ["example.com", "www.example.com", "a.b.example.com", "example.org", "localhost", "Example.COM"]
    paths = ["", "/", "/a", "/a/", "/a/b/c.html", "/b/?q=/a/", "/a//b", "#/a/"]
    captures = []
    for i in range(300):
        url = rnd.choice(["http://", "https://user:p@"]) + rnd.choice(hosts) + rnd.choice(["", ":8080"]) + rnd.choice(paths)
        captures.append((rnd.choice([i, None]), rnd.choice([url] * 20 + [None, "", "no url"]), day(rnd.choice([None, *range(0, 120)] * 2))))
    patterns = ["example.com", "www.example.com", "b.example.com", "localhost", "com", "www.example.com/a/", "example.com/a/b/", "example.com/a//", None]
    entries = []
    for _ in range(120):
        entries.append((rnd.choice("xy"), rnd.choice(patterns), day(rnd.choice([None, *range(-90, 200)])), rnd.choice(["block", "allow", "none"])))
    made = url_filters.filter_urls(
        spark.createDataFrame(captures, CAPTURES).repartition(3), spark.createDataFrame(entries, ENTRIES)
    )
    assert made.columns == ["page_id", "url", "fetched", "verdict", "list", "pattern", "valid_from"]
    assert sorted(map(tuple, made.collect()), key=str) == plain(captures, entries)


def test_odd_tables(spark):
    captures = spark.createDataFrame([(1, "http://a.com/", DAY), (1, "http://a.com/", DAY), (None, None, None)], CAPTURES)
    entries = spark.createDataFrame([("l", "a.com", DAY, "block")], ENTRIES)
    none = entries.limit(0)
    assert [r.verdict for r in url_filters.filter_urls(captures, none).collect()] == ["none"] * 3
    assert url_filters.filter_urls(captures.limit(0), entries).count() == 0
    odd = captures.withColumns({c: F.lit("x") for c in ("list", "verdict", "Pattern", "extra", "_month", "_d", "valid_to", "dated")})
    made = url_filters.filter_urls(odd, entries)
    assert made.columns == ["page_id", "url", "fetched", "extra", "_month", "_d", "valid_to", "dated", "verdict", "list", "pattern", "valid_from"]
    assert sorted((str(r.page_id), r.verdict, r._d) for r in made.collect()) == [("1", "block", "x"), ("1", "block", "x"), ("None", "none", "x")]


def test_long_url(spark):
    url = "http://a.com/" + "x/" * 500 + "?" + "q" * 20_000
    captures = spark.createDataFrame([(1, url, DAY)], CAPTURES)
    entries = spark.createDataFrame([("l", "a.com/" + "x/" * 400, DAY, "block")], ENTRIES)
    assert url_filters.filter_urls(captures, entries).first().verdict == "block"


def test_no_python_in_the_plan(spark, sf_dir):
    from demandkit.llm.queries import QUERIES

    for name in ("op1_url_filters", "op5_benchmark_decontamination"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
