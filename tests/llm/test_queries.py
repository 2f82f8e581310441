import re

import pytest

import __spark_entry__ as registry
from tests.compare import connect, difference
from tidemark.llm import queries

FOLDER = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= set(registry.queries()) and set(queries.SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_its_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, FOLDER), connect(FOLDER), queries.SQL[name]) is None


def test_pages_by_the_contract(spark):
    """Host, path and rule of every url, by another way than the operator's."""
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{FOLDER}/pages.parquet").select("page_id", "url").collect()}
    for r in queries.op3_url_filter(spark, FOLDER).collect():
        after = (urls[r["page_id"]] or "").partition("://")[2]
        host = re.split("[/?#]", after)[0]
        path = re.split("[?#]", after[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fits = [x for x in queries.URL_RULES if f".{host}".endswith(f".{x.host}") and path.startswith(f"/{x.path}")]
        best = max(fits, key=lambda x: len(x.text), default=None)
        assert (r["host"], r["path"], r["rule"]) == (host, path, best and best.text)
        assert r["verdict"] == best.verdict if best else r["verdict"] in ("allow", "block")
