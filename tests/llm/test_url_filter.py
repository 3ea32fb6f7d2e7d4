import datetime as dt
import random

from plotwise.llm import url_filter as U

CAPTURES, ENTRIES = "page_id long, url string, fetched_on date, verdict string", "key string, verdict string, action string, listed_on date, url string"
D = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)


def brute(captures, entries):
    out = []
    for page, url, day in captures:
        host, path = "", []
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host = rest.split("/", 1)[0].split("?", 1)[0].split("#", 1)[0].rsplit("@", 1)[-1].split(":", 1)[0].lower()
            path = [s for s in ("/" + rest.split("/", 1)[1] if "/" in rest.split("?")[0] else "").split("?", 1)[0].split("#", 1)[0].split("/") if s]
        labels = host.split(".")
        keys = {".".join(labels[i:]): len(labels) - i for i in range(max(1, len(labels) - 1))} if host else {}
        keys |= {"/".join([host, *path[: i + 1]]): 1001 + i for i in range(len(path))} if host else {}
        found = []
        for key, rank in keys.items():
            for verdict in ("block", "allow"):
                days = {}
                for k, v, action, on in entries:
                    if k == key and v == verdict and None not in (action, on) and day and on <= day:
                        days[on] = days.get(on, 0) | (action == "add")
                since, on = None, 0
                for x in sorted(days):
                    since = x if days[x] and not on else since
                    on = days[x]
                if on:
                    found.append((rank, since, verdict == "block", key, verdict))
        best = max(found, default=None)
        out.append((page, url, day, int(bool(best and best[2])), len(found), best and best[3], best and best[4], best and best[1]))
    return sorted(out, key=repr)


def test_matches_brute_force(spark):
    rng = random.Random(7)
    hosts = ["a.example.com", "b.example.com", "x.y.example.org", "example.org", "localhost", "Sub.A.Example.com"]
    keys = [*[h.lower() for h in hosts], "example.com", "a.example.com/p", "a.example.com/p/q", "localhost/z", "y.example.org"]
    entries = [(rng.choice(keys), rng.choice(("block", "allow")), rng.choice(("add", "add", "remove")), D(rng.randint(0, 200))) for _ in range(150)]
    entries += entries[:10] + [(None, "block", "add", D(1)), ("example.com", None, "add", D(1)), ("example.com", "block", None, D(1)), ("example.com", "block", "add", None)]
    captures = [(i, f"{rng.choice(('http', 'https'))}://{rng.choice(('', 'u@'))}{rng.choice(hosts)}{rng.choice(('', ':80'))}{rng.choice(('', '/', '/p', '/p/q/r?x=/1', '/z#/y'))}", D(rng.randint(0, 260))) for i in range(300)]
    captures += [(1000, None, D(5)), (1001, "not a url", D(5)), (1002, "http://a.example.com/p", None), (None, "http://a.example.com/p", D(90)), captures[0], captures[0]]
    got = U.judge(spark.createDataFrame([(*c, "x") for c in captures], CAPTURES), spark.createDataFrame([(*e, "x") for e in entries], ENTRIES))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(captures, [e for e in entries if None not in e])


def test_empty_tables(spark):
    captures = spark.createDataFrame([(1, "http://a.b/c", D(1), "x")], CAPTURES)
    entries = spark.createDataFrame([("a.b", "block", "add", D(0), "x")], ENTRIES)
    assert U.judge(captures.limit(0), entries).count() == 0
    assert [r.blocked for r in U.judge(captures, entries.limit(0)).collect()] == [0]
    assert [r.blocked for r in U.judge(captures, entries).collect()] == [1]


def test_plan_is_native(spark):
    plan = U.judge(spark.createDataFrame([(1, "http://a.b/c", D(1), "x")], CAPTURES), spark.createDataFrame([], ENTRIES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan


def test_hosts_addresses_and_registries(spark):
    keys = ["3.4", "2.3.4", "1.2.3.4", "co.uk", "site.co.uk", "example.com", "[::1]", "localhost"]
    urls = {"http://9.2.3.4/": None, "http://1.2.3.4:80/x": "1.2.3.4", "https://shop.co.uk/": None, "https://www.site.co.uk./a": "site.co.uk", "http://co.uk/": "co.uk", "http://u:p@[::1]:8080/x": "[::1]",
            "//www.example.com/a": "example.com", "www.example.com/a?b": "example.com", "EXAMPLE.com.": "example.com", "1.2.3.4/x": "1.2.3.4", "not a url": None, "mailto:a@example.com": None, "http://": None, "localhost": None}
    captures = spark.createDataFrame([(i, u, D(5), "x") for i, u in enumerate(urls)], CAPTURES)
    entries = spark.createDataFrame([(k, "block", "add", D(0), "x") for k in keys], ENTRIES)
    assert {r.url: r.matched_key for r in U.judge(captures, entries).collect()} == urls
