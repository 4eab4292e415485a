import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from adsieve.llm import url_lists as ul

CAPTURES = "page_id long, url string, fetched_on date, host_states string, salt string"
ENTRIES = "kind string, key string, day date, action string, domain string"
D = date(2024, 1, 1)


def test_against_brute_force(spark):
    rng = random.Random(3)
    hosts = ["a.x.org", "b.x.org", "x.org", "y.com", "www.y.com", "z"]
    entries = [(rng.choice(["host", "domain"]), rng.choice(hosts), D + timedelta(rng.randrange(30)), rng.choice(["add", "remove"]), "q") for _ in range(60)]
    entries += entries[:5] + [("host", None, D, "add", ""), ("host", "y.com", None, "add", ""), (None, None, None, None, None), ("host", "z", D, "maybe", "")]
    captures = [(i % 50, f"http://{rng.choice(hosts)}/p", D + timedelta(rng.randrange(35)), "c", "s") for i in range(300)]
    captures += [(1, None, D, None, None), (2, "nonsense", D, "", ""), (None, "HTTPS://u:p@A.X.org:8080/?q", None, "", "")]

    def since(kind, key, day):
        past = key and [(d, a == "add") for k, e, d, a, _ in entries if (k, e) == (kind, key) and d and day and d <= day and a in ("add", "remove")]
        return max(past)[0] if past and max(past)[1] else None

    want = []
    for page, url, day, _, _ in captures:
        host = None if not url or "://" not in url else url.split("://")[1].split("/")[0].split("@")[-1].split(":")[0].lower()
        domain = ".".join(host.split(".")[-2:]) if host else None
        h, d = since("host", host, day), since("domain", domain, day)
        want.append((page, host, day, h, d, bool(h or d)))
    got = [tuple(r) for r in ul.judge(spark.createDataFrame(captures, CAPTURES), spark.createDataFrame(entries, ENTRIES), salt=3).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_intervals_and_empty(spark):
    entries = spark.createDataFrame([("host", "h", D, "add", ""), ("host", "h", D, "remove", ""), ("host", "h", D + timedelta(3), "remove", "")], ENTRIES)
    got = sorted(map(tuple, ul.intervals(entries).collect()))
    assert got == [("host", "h", False, D + timedelta(3), None), ("host", "h", True, D, D + timedelta(3))]
    one = spark.createDataFrame([(1, "http://h/", D, "", "")], CAPTURES)
    assert not ul.judge(one, entries.limit(0)).first()["blocked"]
    assert ul.judge(one.limit(0), entries).count() == 0


def test_domains(spark):
    hosts = ["a.co.uk", "www.a.co.uk", "x.y.org", "10.0.0.1", "z", None]
    df = spark.createDataFrame([(h,) for h in hosts], "h string")
    got = [r.d for r in df.select(ul.domain_of(df.h, ("co.uk", "com.au")).alias("d")).collect()]
    assert got == ["a.co.uk", "a.co.uk", "y.org", None, "z", None]
    entries = spark.createDataFrame([("domain", "0.1", D, "add", ""), ("domain", "a.co.uk", D, "add", "")], ENTRIES)
    pages = spark.createDataFrame([(1, "http://10.0.0.1/", D, "", ""), (2, "http://b.a.co.uk/", D, "", "")], CAPTURES)
    assert {r.page_id: r.blocked for r in ul.judge(pages, entries, suffixes=("co.uk",)).collect()} == {1: False, 2: True}


def test_clashing_columns(spark):
    own = spark.createDataFrame([(1, "http://h/", D, "a", 5)], "page_id long, url string, fetched_on date, key string, valid_to int")
    entries = spark.createDataFrame([("host", "h", D, "add", "", 1)], "kind string, key string, day date, action string, list_salt string, salt int")
    assert ul.judge(own, entries).first()["blocked"]


def test_addresses_in_brackets_and_dots_at_the_end(spark):
    urls = {"http://[2001:DB8::1]:8080/x": "[2001:db8::1]", "http://u@[::1]/": "[::1]", "http://Example.com./a": "example.com", "http://example.com..:80": "example.com", "http://.../": None, "http://[::1": None, "http://a.co.uk?x": "a.co.uk"}
    got = spark.createDataFrame([(u,) for u in urls], "u string").select("u", ul.host_of(F.col("u")).alias("h"), ul.domain_of(ul.host_of(F.col("u")), ul.SUFFIXES).alias("d")).collect()
    assert {r.u: r.h for r in got} == urls
    assert {r.d for r in got} == {None, "example.com", "a.co.uk"}
