"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestar.llm import cutting_stock, decontaminate, near_dedup, neighbours, packing, pii, prefix_trie, quality, ranked_search, repeats, token_files, toxicity, url_filter
from lakestar.llm.common import held_out
from lakestar.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@register
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, TOKENIZER)
    return token_files.read_tokens(spark, path, digest=True)


@register
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), TOKENIZER)


@register
def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=4)


@register
def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


# The rules of the query (host, path, verdict).
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@register
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), spark.createDataFrame(RULES, "host string, path string, verdict string"))


ORACLES["op5_url_filter"] = """
WITH parts AS (
    SELECT page_id,
        translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages
), ruled AS (
    SELECT *, CASE
        WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
        WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
        WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
        WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
        WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule
    FROM parts
)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


@register
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learn = labels.where(~held_out(5, 0)).select("doc_id", F.col("quality").alias("label"))
    scored = quality.score_quality(documents, learn)
    return scored.select("doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@register
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learn = labels.where(~held_out(3, 1)).select("doc_id", F.col("toxic").alias("label"))
    scored = toxicity.score_toxicity(documents, learn)
    return scored.select("doc_id", held_out(3, 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@register
def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    return found.withColumn("base_sha256", F.sha2("base", 256)).drop("base")


@register
def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@register
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations")).drop("enter_at", "exit_at")


# crc32 over decimal digits by its table; every node's leaves and savings by joining it with the nodes of its members.
ORACLES["op11_prefix_trie"] = r"""
WITH crc_table AS (
    SELECT list(c ORDER BY n) AS t FROM (
        SELECT n, list_reduce([n] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c FROM range(256) AS r(n)
    )
), turns AS (
    SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(coalesce(role, '')), md5(coalesce(text, ''))) AS i,
        coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
    SELECT c, c - c % 20 AS base, xor(4294967295, list_reduce([4294967295] || list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
        lambda a, b: xor(a >> 8, t[CAST(xor(a & 255, b) AS INT) + 1]))) % 4 AS h
    FROM (SELECT DISTINCT c FROM turns), crc_table
), moved AS (
    SELECT ids.c, 0 AS own, i, role, text FROM ids JOIN turns ON turns.c = base WHERE i <= h
    UNION ALL SELECT ids.c, 1, i, role, text FROM ids JOIN turns USING (c) WHERE i > h
), rebuilt AS (
    SELECT c, list({'r': role, 't': text} ORDER BY own, i) AS s FROM moved GROUP BY c
), whole AS (SELECT ids.c, coalesce(s, []) AS s FROM ids LEFT JOIN rebuilt USING (c)),
places AS (SELECT c, d, s[1:d] AS p, d = len(s) AS ends FROM whole, LATERAL unnest(range(len(s) + 1)) AS x(d)),
nodes AS (
    SELECT p, CAST(d AS BIGINT) AS depth, min(c) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256,
        CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * len(regexp_extract_all(p[d].t, '[^ 	-
]+')) END AS saved
    FROM places GROUP BY p, d
), owned AS (SELECT places.c, places.d, conv_id, depth FROM places JOIN nodes ON places.p = nodes.p AND places.d = nodes.depth),
linked AS (
    SELECT n.*, o.conv_id AS parent_conv_id FROM nodes n LEFT JOIN owned o ON o.c = n.conv_id AND o.d = n.depth - 1
), children AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY ALL),
counted AS (SELECT linked.*, coalesce(n_children, 0) AS n_children FROM linked LEFT JOIN children USING (conv_id, depth)),
below AS (
    SELECT o.conv_id, o.depth, count(*) FILTER (u.n_children = 0) AS n_leaves, sum(u.saved) AS saved_tokens
    FROM counted u JOIN owned o ON o.c = u.conv_id AND o.d <= u.depth GROUP BY ALL
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM counted JOIN below USING (conv_id, depth)
"""


@register
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op12_ranked_search"] = r"""
WITH found AS (
    SELECT row_number() OVER () AS d, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), sizes AS (SELECT d, any_value(doc_id) AS doc_id, count(*) AS n FROM found GROUP BY d),
total AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
asked AS (
    SELECT DISTINCT i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS i, * FROM (SELECT DISTINCT item_id, text FROM benchmark))
), tfs AS (SELECT d, term, count(*) AS tf FROM found WHERE term IN (SELECT term FROM asked) GROUP BY d, term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tfs, total GROUP BY term, docs),
scores AS (
    SELECT i, item_id, d, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // terms)))) AS BIGINT) AS score
    FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN sizes USING (d), total GROUP BY i, item_id, d, doc_id
)
SELECT item_id, CAST(row_number() OVER best AS INT) AS rank, doc_id, score FROM scores WHERE score > 0
WINDOW best AS (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST) QUALIFY row_number() OVER best <= 50
"""


@register
def op13_cutting_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cutting_stock.pack_documents(table(spark, sf_dir, "documents"), TOKENIZER)
