"""Registered queries of this subpackage, each over its whole tables, and their SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relaydesk.functions.text import bind
from relaydesk.llm import byte_bpe, cap_dedup, fingerprints, gnat_codes, line_dedup, ngram_join, packing, periodic_runs
from relaydesk.llm import quality, residual_packing, toxicity, url_filter, warc
from relaydesk.llm.common import held_out, table
from relaydesk.session import fresh_dir

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(make: Query) -> Query:
    REGISTRY[make.__name__] = make
    return make


@query
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    grammar = toxicity.fit(docs, table(spark, folder, "labels"))
    return toxicity.score_documents(docs, grammar).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


# fixed values of the contract
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


@query
def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(table(spark, folder, "pages"), url_filter.rule_table(spark, URL_RULES)).drop("url")


SQL["op3_url_filter"] = r"""
WITH rules(rhost, rpath, rverdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
fits AS (
  SELECT page_id, rhost || rpath AS rule, rverdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC) AS place
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.rverdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON f.page_id = p.page_id AND f.place = 1
"""


@query
def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_dir(spark, "archive")
    warc.write_archive(table(spark, folder, "pages"), path, revisit_from=0)
    return warc.captures(spark, path, with_payload=False).select(
        F.col("key").alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.col("refers_to_key").alias("refers_to"),
    )


@query
def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    codec = byte_bpe.ByteBpe(
        spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )
    made = table(spark, folder, "documents").select("doc_id", codec.round_trip(F.col("text")).alias("made"))
    return made.select(
        "doc_id",
        codec.count(F.col("made.ids")).alias("n_tokens"),
        F.sha2("made.ids", 256).alias("ids_sha256"),
        F.sha2("made.content", 256).alias("decoded_sha256"),
    )


@query
def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as definition:
        pieces = packing.pack(table(spark, folder, "documents"), definition.read(), capacity=2048, end_id=1, added=True)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    field = quality.fit(docs, table(spark, folder, "labels"))
    return quality.score_documents(docs, field, threshold=0.3).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


@query
def op8_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edit_report(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    out = line_dedup.dedup_lines(docs, characters=line_dedup.CHARACTERS)
    return out.select("doc_id", "text", "n_lines", "n_dropped")


@query
def op2_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_classes(table(spark, folder, "documents"))


@query
def op9_cap_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return cap_dedup.near_vectors(table(spark, folder, "embeddings"))


@query
def op13_tree_packing(spark: SparkSession, folder: str) -> DataFrame:
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as definition:
        pieces = residual_packing.pack(table(spark, folder, "documents"), definition.read(), capacity=2048, end_id=0)
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def _repeating(doc_id: Column, text: Column) -> Column:
    """The contract's texts: in a tenth of the rows the words repeat from one place on."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def repeat(words: Column, a: Column, p: Column) -> Column:
        again = lambda i: F.get(words, (a + (i - a) % p).cast("int"))
        return F.array_join(F.transform(words, lambda w, i: F.when(i < a, w).otherwise(again(i))), " ")

    made = bind(
        F.filter(F.split(text, r"[ \t-\r]+"), lambda w: w != ""),
        lambda words: bind(
            g % F.greatest(F.size(words), F.lit(1)),
            lambda a: bind(1 + F.floor((F.size(words) - a) / (3 + g % 8)), lambda p: repeat(words, a, p)),
        ),
    )
    return F.when(h % 10 == 0, made).otherwise(text)


@query
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", _repeating(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs.find_runs(docs)
    # by exact quotients; the earlier run and then the shorter period first among equals
    ahead = lambda a, b: (
        F.when(a["length"] * b["period"] != b["length"] * a["period"], a["length"] * b["period"] > b["length"] * a["period"])
        .when(a["start"] != b["start"], a["start"] < b["start"])
        .otherwise(a["period"] < b["period"])
    )
    best = F.reduce("runs", F.get("runs", F.lit(0)), lambda a, b: F.when(ahead(b, a), b).otherwise(a))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda r: F.concat(r, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_gnat_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded, books = gnat_codes.compress(table(spark, folder, "embeddings"))
    digest = books.digest() if books else hashlib.sha256(b"").hexdigest()
    return coded.withColumn("codebooks_sha256", F.lit(digest))


def _gnat_codes_sql(rounds: int = 4, entries: int = 256) -> str:
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
near{k} AS (
  SELECT v.vec_id, v.p, v.c, min(list_sum(list_transform(list_zip(v.c, b.c), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) * {entries} + b.e) AS m
  FROM parts v JOIN book{k} b ON v.p = b.p GROUP BY v.vec_id, v.p, v.c)""")
        if k < rounds:
            steps.append(f"""
mean{k} AS (
  SELECT p, e, list(mean ORDER BY i) AS c
  FROM (SELECT p, e, i, CAST(floor(sum(x) / count(*)) AS BIGINT) AS mean
        FROM (SELECT p, m % {entries} AS e, unnest(c) AS x, generate_subscripts(c, 1) AS i FROM near{k}) GROUP BY p, e, i)
  GROUP BY p, e),
book{k + 1} AS (SELECT b.p, b.e, coalesce(n.c, b.c) AS c FROM book{k} b LEFT JOIN mean{k} n ON b.p = n.p AND b.e = n.e)""")
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT vec_id, p, list_slice(q, p * len(q) // 4 + 1, (p + 1) * len(q) // 4) AS c FROM kept, range(4) AS t(p)),
book0 AS (
  SELECT p, e, c FROM (SELECT p, c, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM parts) WHERE e < {entries}),
{",".join(steps)},
coded AS (
  SELECT vec_id, string_agg(format('{{:02x}}', m % {entries}), '' ORDER BY p) AS code, CAST(sum(m // {entries}) AS BIGINT) AS error
  FROM near{rounds} GROUP BY vec_id),
digest AS (
  SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256
  FROM (SELECT p, e, unnest(c) AS x, generate_subscripts(c, 1) AS i FROM book{rounds}))
SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, d.codebooks_sha256
FROM kept k JOIN coded c ON k.vec_id = c.vec_id CROSS JOIN digest d
"""


SQL["op12_gnat_codes"] = _gnat_codes_sql()
