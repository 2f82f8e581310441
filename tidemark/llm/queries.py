"""The numbered operators as queries over whole tables, and SQL where it can say the same."""

from __future__ import annotations

import functools
import os
import tempfile
import zipfile
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe,
    decontaminate,
    license_scan,
    prefix_trie,
    quality_rules,
    recompression,
    rule_ensemble,
    secret_scan,
    simhash,
    suffix_dedup,
    transcripts,
    turn_repair,
    url_filter,
)
from tidemark.llm.text import table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@functools.cache
def _ship(application: str, spark: SparkSession) -> None:
    """Give the Python workers this package, where they don't find it on their own path."""
    package = Path(__file__).resolve().parents[1]
    # Spark serves the file to the executors; nothing else reads this folder.
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark_workers.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, str(f.relative_to(package.parent)))
    spark.sparkContext.addPyFile(path)


def ship(spark: SparkSession) -> None:
    _ship(spark.sparkContext.applicationId, spark)


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = (RANKS, public_tokenizers.PATTERN)
    first = bpe.encoding(*vocabulary), bpe.dropping("text")
    return bpe.chain(docs, *first, bpe.decoding(*vocabulary), bpe.digesting())


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.leaks(docs, table(spark, sf_dir, "benchmark"))
    share = F.round(F.col("n_shared") / F.col("n_shingles"), 6).alias("containment")
    return found.select("doc_id", "item_id", "n_shared", "n_shingles", share)


# The rules of the contract.
URL_RULES = (
    url_filter.Rule("org", "", "allow"),
    url_filter.Rule("example.org", "es/", "block"),
    url_filter.Rule("example.org", "en/1", "block"),
    url_filter.Rule("com", "fr/", "allow"),
    url_filter.Rule("com", "de/", "block"),
)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that no rule fits are blocked on hosts with a tenth or more of titles of symbol junk."""
    pages = table(spark, sf_dir, "pages")
    judged = url_filter.judge(pages.select("page_id", "url"), URL_RULES, url_filter.spam_hosts(pages))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return suffix_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    names = [f.name for f in license_scan.RESULTS if f.name != "spans"]
    return license_scan.scan(docs).select("doc_id", *names)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return simhash.classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    return quality_rules.judge(docs).select(
        "doc_id", *quality_rules.COUNTS, "base_failed", "kept", F.round("distance", 3).alias("distance")
    )


def raw_transcripts(conversations: DataFrame) -> DataFrame:
    """``conversations`` as transcripts: seven rows in ten begin with a marker, in two styles."""
    style = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(10))
    plain = F.concat(F.initcap("role"), F.lit(": "))
    other = {"user": "### Human: ", "assistant": "### AI: ", "system": "[Instructions]: "}
    marked = F.lit("")
    for role, marker in other.items():
        marked = F.when(F.col("role") == role, F.lit(marker)).otherwise(marked)
    marker = F.when(style < 5, plain).when(style < 7, marked).otherwise("")
    text = F.concat(F.coalesce(marker, F.lit("")), F.coalesce("text", F.lit("")))
    return conversations.select("conv_id", "turn", "role", text.alias("text"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles are learned from four fifths of the conversations and recovered for all of them.

    The rows are consecutive pieces of a transcript; where a row ends is no evidence.
    """
    ship(spark)
    chunks = transcripts.pack(raw_transcripts(table(spark, sf_dir, "conversations")), role="role")
    held = F.crc32(F.coalesce(F.col("conv").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    return transcripts.turns(chunks, transcripts.train(chunks.where(~held))).withColumnRenamed("conv", "conv_id")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.scan(docs).select("doc_id", "at", "value", "score", "secret")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rule_ensemble.classify(docs, table(spark, sf_dir, "labels"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults by the checksum of their place: dropped, emptied, cut, repeated, of another role."""
    space = F.lit(" ")
    part = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(part[0], F.lit(":"), part[1]).cast("binary")) % 20
    text = F.coalesce("text", space)
    text = F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(kind == 4, "user").otherwise(F.coalesce("role", space))
    times = F.explode(F.array_repeat(F.lit(1), F.when(kind == 3, 2).otherwise(1)))
    rows = conversations.where(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("n"))
    return rows.drop("n")


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    conversations = table(spark, sf_dir, "conversations")
    return turn_repair.repair(damaged(conversations), conversations)


def op12_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return recompression.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_byte_bpe,
        op2_decontamination,
        op3_url_filter,
        op4_suffix_dedup,
        op5_license_scan,
        op6_simhash,
        op7_quality_rules,
        op8_chat_format,
        op9_secret_scan,
        op10_quality_classifier,
        op11_turn_repair,
        op12_recompression,
        op13_prefix_trie,
    )
}

_SPLIT = r"""regexp_split_to_array(trim(regexp_replace(lower(coalesce(text, '')),
  '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g')), ' ')"""

_OP2 = f"""
WITH items AS (
  SELECT item_id, t, w, least(5, len(w)) AS n FROM (
    SELECT item_id, text AS t, {_SPLIT} AS w FROM (SELECT DISTINCT item_id, coalesce(text, '') AS text FROM benchmark))
  WHERE len(w) > 0 AND w[1] <> ''),
item_runs AS (
  SELECT DISTINCT item_id, t, n, array_to_string(w[i:i + n - 1], ' ') AS run FROM (
    SELECT *, unnest(generate_series(1, len(w) - n + 1)) AS i FROM items)),
item_sizes AS (SELECT item_id, t, count(*) AS n_shingles FROM item_runs GROUP BY item_id, t),
docs AS (SELECT row_number() OVER () AS row_no, doc_id, {_SPLIT} AS w FROM documents),
doc_runs AS (
  SELECT DISTINCT row_no, doc_id, n, array_to_string(w[i:i + n - 1], ' ') AS run FROM (
    SELECT row_no, doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
    FROM docs JOIN (SELECT DISTINCT n FROM items) ON len(w) >= n))
SELECT doc_id, x.item_id, n_shared, n_shingles, round(n_shared / n_shingles, 6) AS containment FROM (
  SELECT row_no, doc_id, r.item_id, r.t, count(*) AS n_shared
  FROM doc_runs d JOIN item_runs r ON d.run = r.run AND d.n = r.n GROUP BY row_no, doc_id, r.item_id, r.t) x
JOIN item_sizes s ON x.item_id IS NOT DISTINCT FROM s.item_id AND x.t = s.t
WHERE n_shared >= 0.8 * n_shingles"""


def _rule_cases(what: str) -> str:
    cases = []
    for r in sorted(URL_RULES, key=lambda r: -len(r.text)):
        path = r.path.replace("'", "''")
        fits = f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '/{path}')"
        cases.append(f"WHEN {fits} THEN '{getattr(r, what)}'")
    return "CASE " + " ".join(cases) + " END"


_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_OP3 = f"""
WITH after_ AS (
  SELECT page_id, coalesce(html, '') AS html,
         CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS a
  FROM pages),
parts AS (
  SELECT page_id, html, translate(regexp_extract(a, '^([^/?#]*)', 1), '{_CAPITALS}', '{_CAPITALS.lower()}') AS host,
         regexp_extract(a, '^[^/?#]*([^?#]*)', 1) AS path FROM after_),
listed AS (
  SELECT host AS key FROM parts WHERE host <> '' GROUP BY host
  HAVING avg(CASE WHEN regexp_matches(html, '(?i)<title>[^<]*[#*$%&|]{{3}}') THEN 1.0 ELSE 0.0 END) >= 0.1)
SELECT page_id, host, path, {_rule_cases("text")} AS rule,
       coalesce({_rule_cases("verdict")}, CASE WHEN host IN (SELECT key FROM listed) THEN 'block' ELSE 'allow' END)
       AS verdict
FROM parts"""

#: Only what SQL can say: the others hash, merge, train or decode, or would compare all strings.
SQL: dict[str, str] = {"op2_decontamination": _OP2, "op3_url_filter": _OP3}
