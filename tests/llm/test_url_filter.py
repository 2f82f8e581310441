from pyspark.sql import functions as F

from tidemark.llm import url_filter as u
from tidemark.llm.queries import URL_RULES


def _universe(spark, n=3000, every=7):
    return spark.range(n).select(
        F.concat(F.lit("host"), "id").alias("key"), (F.pmod(F.xxhash64("id"), F.lit(every)) == 0).alias("listed")
    )


def test_cascade_is_exact(spark):
    for every in (2, 7, 500):
        universe = _universe(spark, every=every)
        found = u.cascade(universe)
        wrong = universe.where(found.holds(F.col("key")) != F.col("listed"))
        assert wrong.count() == 0 and len(found.levels) >= 1


def test_cascade_of_nothing_and_of_everything(spark):
    none = _universe(spark, 50).withColumn("listed", F.lit(False))
    assert none.where(u.cascade(none).holds(F.col("key"))).count() == 0
    every = none.withColumn("listed", F.lit(True))
    assert every.where(u.cascade(every).holds(F.col("key"))).count() == 50


URLS = {
    "http://Sub.Example.ORG/es/1": ("sub.example.org", "/es/1", "example.org/es/", "block"),
    "http://example.org/en/12?q": ("example.org", "/en/12", "example.org/en/1", "block"),
    "http://example.org/en/2#x": ("example.org", "/en/2", "org/", "allow"),
    "https://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
    "http://a.com/de/x": ("a.com", "/de/x", "com/de/", "block"),
    "http://a.com/DE/x": ("a.com", "/DE/x", None, "block"),
    "http://bad.net?x=/es/": ("bad.net", "", None, "block"),
    "x://y.net/a://b/c": ("y.net", "/a://b/c", None, "allow"),
    "http://org": ("org", "", None, "allow"),
    "no scheme": ("", "", None, "allow"),
    "": ("", "", None, "allow"),
    None: ("", "", None, "allow"),
}


def test_rules_and_list(spark):
    df = spark.createDataFrame([(i, x, "z") for i, x in enumerate([*URLS, *URLS])], "page_id long, url string, host string")
    keys = sorted({v[0] for v in URLS.values()} - {""})
    universe = spark.createDataFrame([(k, k in ("a.com", "bad.net")) for k in keys], "key string, listed boolean")
    for largest in (u.LARGEST, 1):  # by the cascade, and by the join beyond its bound
        got = u.judge(df, URL_RULES, universe, largest=largest).collect()
        assert len(got) == 2 * len(URLS)
        for r in got:
            assert (r["host"], r["path"], r["rule"], r["verdict"]) == URLS[r["url"]]


def test_spam_hosts_and_empty_table(spark):
    rows = [(1, "http://a.x/1", "<TITLE>buy*** $$$now</title>"), (2, "http://a.x/2", None), (3, "http://b.x/", "<title>ok</title> ###"), (4, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["key"]: r["listed"] for r in u.spam_hosts(pages).collect()} == {"a.x": True, "b.x": False}
    none = pages.limit(0)
    assert u.judge(none, URL_RULES, u.spam_hosts(none)).count() == 0
