"""Filter lists as of the fetch time, against a plain replay of the log."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest

from tests.oracle import compare, connect
from tidemark.llm import url_lists

SF = "/root/testdata/sf0.01"
DAY = dt.datetime(2024, 3, 1)
LOG = "kind string, pattern string, category string, action string, listed_at timestamp_ntz"
CAPTURES = "page_id long, url string, fetched_at timestamp_ntz, kind int"


def hours(n):
    return DAY + dt.timedelta(hours=n)


def listed_by(kind, pattern, url):
    m = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?([^/?#:]*)(?::\d*)?([^?#]*)", url or "")
    if not m or not m.group(1).rstrip("."):
        return False
    host, path = m.group(1).lower().rstrip("."), m.group(2) or "/"
    if kind == "host":
        return host == pattern
    if kind == "domain":
        return host == pattern or host.endswith("." + pattern)
    return host + path == pattern or pattern.endswith("/") and (host + path).startswith(pattern)


def replay(log, url, at):
    """Active entries at a time, by running through the log in order."""
    since = {}
    for kind, pattern, category, action, when in sorted((e for e in log if None not in e), key=lambda e: (e[4], e[3])):
        key = kind, pattern, category
        if when <= at and action == "add":
            since.setdefault(key, when)
        elif when <= at and action == "remove":
            since.pop(key, None)
    hits = [(k, w) for k, w in since.items() if listed_by(k[0], k[1], url)]
    return len(hits), ",".join(sorted({k[2] for k, _ in hits})) or None, min((w for _, w in hits), default=None)


def same_moment(log):
    """A removal of the same moment wins, whatever was added then."""
    removed = {(k, p, c, t) for k, p, c, a, t in log if a == "remove"}
    return [e for e in log if e[3] == "remove" or (e[0], e[1], e[2], e[4]) not in removed]


@pytest.mark.parametrize("seed", range(3))
def test_against_a_replay(spark, seed):
    rng = random.Random(seed)
    hosts = ["a.example.com", "b.example.com", "EXAMPLE.com", "example.org", "x.y.example.org.", "com"]
    paths = ["", "/", "/en", "/en/", "/en/1.html", "/fr/2?q=1", "/en//x#top"]
    patterns = {"host": ["a.example.com", "example.com", "example.org"], "domain": ["example.com", "com", "y.example.org", "example.org"],
                "prefix": ["a.example.com/en/", "example.com/en", "b.example.com/", "example.org/en/1.html"]}
    log = []
    for _ in range(150):
        kind = rng.choice(list(patterns))
        log.append((kind, rng.choice(patterns[kind]), rng.choice(["spam", "adult"]), rng.choice(["add", "remove"]), hours(rng.randrange(0, 200, 2))))
    log += [(None, "a", "spam", "add", DAY), ("host", None, "spam", "add", DAY), ("host", "a.example.com", "x", "add", None), ("odd", "com", "x", "add", DAY)]
    captures = [
        (k, f"{rng.choice(['http', 'https'])}://{rng.choice(['', 'me@'])}{rng.choice(hosts)}{rng.choice(['', ':80'])}{rng.choice(paths)}", hours(rng.randrange(-5, 260)), k % 5)
        for k in range(200)
    ]
    captures += [(1, None, DAY, 1), (2, "no url", DAY, 1), (3, "http://com/", None, 1), captures[0], captures[0], (None, *captures[5][1:])]
    got = url_lists.evaluate(spark.createDataFrame(captures, CAPTURES), spark.createDataFrame(log, LOG))
    assert got.columns == ["page_id", "url", "fetched_at", "kind", "n_matches", "categories", "listed_since"]
    usable = same_moment([e for e in log if None not in e and e[0] in patterns])
    want = [(*c, *(replay(usable, c[1], c[2]) if c[2] else (0, None, None))) for c in captures]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert sum(w[4] > 0 for w in want) > 30


def test_query_equals_sql(spark):
    ok, note = compare(url_lists.op3_url_lists(spark, SF), connect(SF), url_lists.ORACLE_SQL["op3_url_lists"])
    assert ok, note
    matched = url_lists.op3_url_lists(spark, SF).where("n_matches > 0").count()
    assert matched > 10


def test_intervals_begin_and_end(spark):
    log = [("host", "h", "spam", a, hours(t)) for a, t in [("remove", 0), ("add", 1), ("add", 30), ("remove", 60), ("add", 60), ("add", 100), ("remove", 101)]]
    rows = url_lists.intervals(spark.createDataFrame(log, LOG)).orderBy("valid_from").collect()
    assert [(r.valid_from, r.valid_to) for r in rows] == [(hours(1), hours(60)), (hours(100), hours(101))]


def test_empty_tables(spark):
    captures, log = spark.createDataFrame([], CAPTURES), spark.createDataFrame([], LOG)
    assert url_lists.evaluate(captures, log).count() == 0
    one = url_lists.evaluate(spark.createDataFrame([(1, "http://a/", DAY, 0)], CAPTURES), log).collect()
    assert [(r.n_matches, r.categories) for r in one] == [(0, None)]


def test_open_intervals_cost_only_the_periods_that_are_asked(spark):
    log = [("host", f"h{k}.org", c, "add", hours(-24 * 3650 + k)) for k in range(50) for c in ("spam", "adult")]
    log += [("host", "h1.org", "spam", "remove", hours(-24 * 1000)), ("host", "h1.org", "spam", "add", hours(24 * 9))]
    spans = url_lists.intervals(spark.createDataFrame(log, LOG))
    asked = [("host", "h1.org", url_days(t)) for t in (-3649, -500, 0, 9)] + [("host", "h2.org", url_days(0)), ("host", "other.org", url_days(0))]
    pieces = url_lists._pieces(spans, spark.createDataFrame(asked, "kind string, pattern string, __period long"), 1)
    # 101 beginnings; h1 is open 4 times as adult and once as spam before its second start, h2 twice.
    assert pieces.count() == 101 + 4 + 1 + 2


def url_days(n):
    return (DAY + dt.timedelta(days=n) - dt.datetime(1970, 1, 1)).days
