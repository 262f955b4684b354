from __future__ import annotations

import datetime
import random

from tillroll.llm import url_filters

DAY = datetime.date(2021, 1, 1)
ENTRIES = "pattern string, effect string, day date, action string"
CAPTURES = "page_id bigint, url string, fetched_on date"


def day(n):
    return DAY + datetime.timedelta(days=n)


def decide(entries, url, fetched):
    """State of every pattern on the day, by replaying its entries in order."""
    rest = (url or "").split("://", 1)
    if len(rest) < 2 or fetched is None:
        return 0, None, False
    host, _, path = rest[1].split("?")[0].split("#")[0].partition("/")
    host = host.rpartition("@")[2].split(":")[0].lower().rstrip(".")
    labels, parts = host.split("."), [p for p in path.split("/") if p]
    keys = {".".join(labels[i:]) for i in range(len(labels))} | {"/".join([host, *parts[: i + 1]]) for i in range(len(parts))}
    state = {}
    for pattern, effect, when, action in sorted(entries, key=lambda e: (e[2], e[3] == "add")):
        if pattern in keys and when <= fetched:
            state[pattern, effect] = action == "add"
    held = [(len(p), p, e == "allow") for (p, e), on in state.items() if on]
    top = max(held, default=(0, None, True))
    return len(held), top[1], not top[2]


def test_filtered_follows_replay(spark):
    draw = random.Random(5)
    hosts = ["a.example.org", "b.a.example.org", "x.net", "example.org"]
    patterns = hosts + ["org", "x.net/en", "x.net/en/7", "a.example.org/de", "nothing.com"]
    entries = [
        (draw.choice(patterns), draw.choice(["block", "allow"]), day(draw.randint(0, 400)), draw.choice(["add", "remove"]))
        for _ in range(60)
    ]
    captures = [
        (i, f"https://{draw.choice(hosts).upper()}:80/{draw.choice(['en', 'de'])}//{draw.randint(6, 8)}?q=1#f", day(draw.randint(-10, 450)))
        for i in range(300)
    ]
    captures += [(900, None, day(5)), (901, "not a url", day(5)), (902, "http://x.net", None), (903, "http://u:p@x.net./", day(399)), (900, "ftp://x.net/en/7/8/9", day(300)), (None, "http://x.net/en", day(300))]
    frame = spark.createDataFrame(captures, CAPTURES).selectExpr("*", "'x' AS host", "1 AS active", "'y' AS pattern", "0 AS path")
    got = url_filters.filtered(frame, spark.createDataFrame(entries, ENTRIES)).collect()
    want = sorted(((i, when, *decide(entries, url, when)) for i, url, when in captures), key=repr)
    assert sorted(((r.page_id, r.fetched_on, r.active, r.decided_by, r.blocked) for r in got), key=repr) == want
    assert any(r.blocked for r in got) and any(r.active and not r.blocked for r in got)


def test_intervals(spark):
    entries = [("p", "block", day(n), a) for n, a in [(1, "add"), (3, "add"), (5, "remove"), (6, "remove"), (9, "remove"), (9, "add")]]
    entries += [(None, "block", day(1), "add"), ("q", "block", None, "add"), ("q", "allow", day(2), "remove")]
    got = url_filters.intervals(spark.createDataFrame(entries, ENTRIES)).collect()
    assert sorted(map(tuple, got)) == [("p", "block", day(1), day(5)), ("p", "block", day(9), None)]


def test_empty_tables(spark):
    no_entries, no_captures = spark.createDataFrame([], ENTRIES), spark.createDataFrame([], CAPTURES)
    one = spark.createDataFrame([(1, "http://a.b/", day(1))], CAPTURES)
    some = spark.createDataFrame([("a.b", "block", day(0), "add")], ENTRIES)
    assert [tuple(r) for r in url_filters.filtered(one, no_entries).collect()] == [(1, "a.b", day(1), 0, None, False)]
    assert url_filters.filtered(no_captures, some).collect() == []
    assert url_filters.filtered(one, some).first().blocked
