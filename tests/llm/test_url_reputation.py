from conftest import SF_MID
from oracle import compare, duck
from pyspark.sql import functions as F

from fixtures import table
from segmint.llm import url_reputation as U


def test_equals_sql(spark):
    ok, message = compare(U.url_verdicts(table(spark, SF_MID, "pages"), table(spark, SF_MID, "labels")), duck(SF_MID), U.ORACLE)
    assert ok, message


def test_hosts_paths_and_rules(spark):
    urls = ["HTTP://User@WWW.Example.ORG:80/es/A?q=/x#f", "https://example.org/en/15", "https://badexample.org/es/1", "https://example.org?x=/es/", "x://a.com#/de/",
            "https://b.example.com/de/1", None, "no scheme/es/", "https://example.org/es", "://x.org/", "a://b.com/fr/://c", "https://ÄÖ.org/é?x"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(0, urls[0])], "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, bad int")
    rows = U.judge_urls(df, none).collect()
    assert len(rows) == len(urls) + 1
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows}
    assert got[0] == ("user@www.example.org:80", "/es/A", None, "allow")
    assert got[1] == ("example.org", "/en/15", "example.org/en/1", "block")
    assert got[2] == ("badexample.org", "/es/1", "org/", "allow")
    assert got[3] == ("example.org", "", None, "allow") and got[4] == ("a.com", "", None, "allow")
    assert got[5][2:] == ("com/de/", "block") and got[6] == got[7] == ("", "", None, "allow")
    assert got[8][2:] == ("org/", "allow") and got[9][:3] == ("x.org", "/", "org/")
    assert got[10] == ("b.com", "/fr/://c", "com/fr/", "allow") and got[11][0] == "ÄÖ.org"
    assert U.judge_urls(df.limit(0), none).count() == 0


def test_registered_domains(spark):
    hosts = ["a.b.example.com", "x.co.uk", "a.x.co.uk", "u@h.org:8080", "10.0.0.1", "[::1]", "localhost", "", "a.com.mx", "b.gov.uk", "c.co.kr", "me.github.io", "co.xyz.net"]
    d, s = U.domain_and_suffix(F.col("h"))
    got = spark.createDataFrame([(h,) for h in hosts], "h string").select("h", d.alias("d"), s.alias("s")).collect()
    assert {r.h: (r.d, r.s) for r in got} == {"a.b.example.com": ("example.com", "com"), "x.co.uk": ("x.co.uk", "co.uk"), "a.x.co.uk": ("x.co.uk", "co.uk"),
                                              "u@h.org:8080": ("h.org", "org"), "10.0.0.1": ("10.0.0.1", ""), "[::1]": ("[::1]", ""),
                                              "localhost": ("localhost", "localhost"), "": ("", ""), "a.com.mx": ("a.com.mx", "com.mx"),
                                              "b.gov.uk": ("b.gov.uk", "gov.uk"), "c.co.kr": ("c.co.kr", "co.kr"), "me.github.io": ("me.github.io", "github.io"),
                                              "co.xyz.net": ("xyz.net", "net")}


def test_shrinkage_and_bound(spark):
    """Many bad pages block a host, one does not; a silent host of a bad
    domain is between its domain and the rest."""
    hosts = [(f"h{i}.good.net", 50, 3) for i in range(20)] + [(f"h{i}.bad.net", 50, 47) for i in range(20)] + [
        ("new.bad.net", 0, 0), ("one.good.net", 1, 1), ("new.good.net", 0, 0)]
    got = {r.host: r for r in U.reputations(spark.createDataFrame(hosts, "host string, n long, k long")).collect()}
    assert got["h1.bad.net"].bound > 0.5 > got["one.good.net"].bound
    assert got["new.bad.net"].mean > 0.8 > 0.3 > got["new.good.net"].mean
    assert got["h1.good.net"].mean < got["one.good.net"].mean < 0.5
    assert all(0 <= r.bound <= r.mean for r in got.values())


def test_blocks_by_the_bound(spark):
    pages = spark.createDataFrame([(i, f"https://spam.net/{i}") for i in range(40)] + [(100 + i, f"https://fine{i % 4}.net/{i}") for i in range(80)], "page_id long, url string")
    outcomes = spark.createDataFrame([(i, 1) for i in range(40)] + [(100 + i, 0) for i in range(80)] + [(100, 0), (None, 1), (101, None)], "page_id long, bad int")
    got = {(r.host, r.verdict) for r in U.judge_urls(pages, outcomes).collect()}
    assert got == {("spam.net", "block"), *((f"fine{i}.net", "allow") for i in range(4))}


def test_null_ids_and_clashing_names(spark):
    df = spark.createDataFrame([(None, "https://a.net/x"), (None, "https://a.net/x"), (1, None)], "page_id long, url string").withColumns(
        {c: F.lit("z") for c in ("host", "domain", "suffix", "n", "k", "m", "prior", "bound", "rule", "verdict")})
    bad = spark.createDataFrame([(None, 1), (1, 1), (1, 0)], "page_id long, bad int")
    rows = U.judge_urls(df, bad).collect()
    assert sorted((str(r.page_id), r.host) for r in rows) == [("1", ""), ("None", "a.net"), ("None", "a.net")]
