import random
from datetime import date, timedelta

from tidemark.llm import url_filter

START = date(2024, 1, 1)


def active(entries, day):
    """Entries that hold on a day, by replaying all events before its end."""
    state = {}
    days = {}
    for value, name, allow, when, added in entries:
        if None not in (value, name, when, added):
            key = (value.lower(), name, bool(allow), when)
            days[key] = days.get(key, False) or added
    for (value, name, allow, when), added in sorted(days.items(), key=lambda x: x[0][3]):
        if when <= day:
            state[value, name, allow] = added
    return [k for k, on in state.items() if on]


def judged(url, day, entries):
    if url is None or day is None or "://" not in url:
        return (False, "", None)
    rest = url.split("://", 1)[1]
    for mark in "#?":
        rest = rest.split(mark, 1)[0]
    host, _, path = rest.partition("/")
    host = host.rsplit("@", 1)[-1].split(":")[0].lower().rstrip(".")
    if not host:
        return (False, "", None)
    labels, parts = host.split("."), [p for p in path.split("/") if p]
    values = {".".join(labels[i:]) for i in range(len(labels))} | {"/".join([host, *parts[:n]]) for n in range(1, len(parts) + 1)}
    hits = [e for e in active(entries, day) if e[0] in values]
    allowed = max([len(v) for v, _, allow in hits if allow], default=-1)
    kept = [(v, n) for v, n, allow in hits if not allow and len(v) > allowed]
    if not kept:
        return (False, "", None)
    return (True, ",".join(sorted({n for _, n in kept})), min(kept, key=lambda x: (-len(x[0]), x[0]))[0])


def run(spark, captures, entries):
    pages = spark.createDataFrame([(*c, 1, "x") for c in captures], "page_id long, url string, fetched date, value int, day string").repartition(3)
    events = spark.createDataFrame([(*e, 5, "y") for e in entries], "value string, list string, allow boolean, day date, added boolean, until int, url string")
    return sorted((str(r.page_id), r.blocked, r.lists, str(r.value)) for r in url_filter.judge(pages, events).collect())


def want(captures, entries):
    return sorted((str(i), *judged(u, d, entries)[:2], str(judged(u, d, entries)[2])) for i, u, d in captures)


def test_brute_force(spark):
    rng = random.Random(4)
    hosts = ["a.example.com", "b.example.com", "example.com", "x.org", "deep.sub.x.org"]
    paths = ["", "/", "/en", "/en/1", "/en//1/?q=1", "/EN/2#top", "/a/b/c/d/e/f/g/h/i/j"]
    entries = []
    for _ in range(120):
        host = rng.choice(hosts)
        value = rng.choice([host, host + "/en", host + "/en/1", host.upper(), "org"])
        entries.append((value, rng.choice(["spam", "adult"]), rng.random() < 0.3, START + timedelta(rng.randrange(900)), rng.random() < 0.6))
    entries += [(None, "spam", False, START, True), ("x.org", None, False, START, True), ("x.org", "spam", None, START, True), ("x.org", "spam", False, None, True)]
    captures = [
        (k, rng.choice(["http://", "https://user:pw@"]) + rng.choice(hosts).title() + rng.choice(["", ":8080", "."]) + rng.choice(paths), START + timedelta(rng.randrange(1000))) for k in range(300)
    ]
    captures += captures[:20]
    captures += [(None, "http://x.org/", START), (900, None, START), (901, "not a url", START), (902, "", START), (903, "http://x.org/", None), (904, "http:///nothing", START)]
    captures += [(905, "http://x.org/" + "p/" * 20_000, START + timedelta(500)), (906, "mailto:me@x.org", START)]
    assert run(spark, captures, entries) == want(captures, entries)


def test_same_day_events_and_ends(spark):
    entries = [("x.org", "spam", False, START, True), ("x.org", "spam", False, START, False), ("x.org", "spam", False, START + timedelta(3), False)]
    captures = [(k, "http://x.org/", START + timedelta(k - 1)) for k in range(6)]
    got = run(spark, captures, entries)
    assert got == want(captures, entries) and [g[1] for g in got] == [False, True, True, True, False, False]


def test_paths_keep_their_case(spark):
    later = START + timedelta(5)
    entries = [("X.org/EN", "spam", False, START, True), ("x.org/EN", "spam", False, later, False), ("x.org/en", "adult", False, START, True)]
    entries += [("y.org", "spam", False, START, True), ("Y.org/Ok", "spam", True, START, True)]
    urls = ["http://x.org/EN", "http://X.ORG/EN/a", "http://x.org/en", "http://x.org/En", "http://y.org/Ok", "http://y.org/ok"]
    captures = [(k, url, day) for k, (url, day) in enumerate((u, d) for d in (START, later) for u in urls)]
    found = {int(k): (lists, value) for k, _, lists, value in run(spark, captures, entries)}
    same = [("adult", "x.org/en"), ("", "None"), ("", "None"), ("spam", "y.org")]
    gone = [("", "None")] * 2
    assert [found[k] for k in range(12)] == [("spam", "x.org/EN")] * 2 + same + gone + same


def test_entries_of_any_depth(spark):
    deep, deeper = "x.org" + "/p" * 9, "x.org" + "/p" * 300
    entries = [(deep, "spam", False, START, True), (deeper, "spam", True, START, True), ("y.org", "adult", False, START, True)]
    entries += [("y.org/" + "/".join("abcdefghijkl"), "adult", True, START, True)]
    urls = ["http://" + x for x in (deep, deep + "/q", deep[:-2], deeper, deeper + "/p", deeper[:-2], "y.org/a/b/c/d/e/f/g/h/i/j/k", "y.org/a/b/c/d/e/f/g/h/i/j/k/l?q")]
    blocked = {int(k): on for k, on, *_ in run(spark, [(k, url, START) for k, url in enumerate(urls)], entries)}
    assert [blocked[k] for k in range(len(urls))] == [True, True, False, False, False, True, True, False]


def test_empty(spark):
    assert run(spark, [], [("x.org", "spam", False, START, True)]) == []
    assert run(spark, [(1, "http://x.org/", START)], []) == [("1", False, "", "None")]


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "http://x.org/", START)], "page_id long, url string, fetched date")
    events = spark.createDataFrame([("x.org", "spam", False, START, True)], "value string, list string, allow boolean, day date, added boolean")
    plan = url_filter.judge(pages, events)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
