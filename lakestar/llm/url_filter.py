"""Operator 5: URL rules by host-suffix and path-prefix expressions, hash prefixes and full digests. DataFrame functions only.

Each URL is expanded into the expressions that a rule could have: the last labels of its host, for every number of labels
that occurs in the rules, with the part of its path up to a slash, for every number of slashes that occurs. Rules are found
by an equi-join on the first bytes of the expression's digest; the whole digest and the rule's own path confirm, and the
longest rule decides (of equal ones, block before allow).

Defined results: a NULL URL or one without "://" has empty host and path and meets no rule; without a rule the verdict is
``DEFAULT``; repeated rows stay repeated; empty tables and empty rule lists are allowed; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakestar.operators.skew import count_copies, expand_copies

# Verdict where no rule fits.
DEFAULT = "allow"
# Hexadecimal digits of the digest that are joined on.
SHORT = 8


def _host(url: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), upper, upper.lower())


def _path(url: Column) -> Column:
    return F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _digest(expression: Column) -> Column:
    return F.sha2(expression.cast("binary"), 256)


def _rules(rules: DataFrame) -> DataFrame:
    """Rules with the expression they are found by: the host and the path up to its last slash."""
    stem = F.concat("rule_host", F.regexp_extract("rule_path", "(?s)^(.*/)?", 0))
    return (
        rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict"))
        .withColumn("rule_digest", _digest(stem))
        .withColumn("short", F.substring("rule_digest", 1, SHORT))
    )


def judge(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages`` (page_id, url) by ``rules`` (host, path, verdict), whose
    paths start with a slash."""
    # Numbers of labels and of slashes in the rules: a few small numbers, however many rules.
    shape = rules.agg(
        F.sort_array(F.collect_set(F.size(F.split("host", r"\.")))).alias("labels"),
        F.sort_array(F.collect_set(F.length("path") - F.length(F.replace("path", F.lit("/"))))).alias("slashes"),
    ).first()
    # Rows are copies if they agree in what the result shows of them: URLs of one page that differ elsewhere are counted together.
    urls = count_copies(pages.select("page_id", F.coalesce(_host(F.col("url")), F.lit("")).alias("host"), F.coalesce(_path(F.col("url")), F.lit("")).alias("path")))
    if not shape["labels"]:
        rules = pages.sparkSession.createDataFrame([], "host string, path string, verdict string")
    n_labels = F.size(F.split("host", r"\."))
    n_slashes = F.length("path") - F.length(F.replace("path", F.lit("/")))
    suffixes = F.array(*[F.when(n_labels >= n, F.substring_index("host", ".", -n)) for n in shape["labels"] or [1]])
    prefixes = F.array(*[F.when(n_slashes >= n, F.concat(F.substring_index("path", "/", n), F.lit("/"))) for n in shape["slashes"] or [1]])
    pairs = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))
    expanded = urls.withColumn("expression", F.explode_outer(F.filter(pairs, lambda x: x.isNotNull())))
    expanded = expanded.withColumn("digest", _digest(F.col("expression"))).withColumn("short", F.substring("digest", 1, SHORT))
    found = expanded.join(_rules(rules), "short", "left")
    fits = (F.col("digest") == F.col("rule_digest")) & F.startswith("path", "rule_path")
    rule = F.concat("rule_host", "rule_path")
    ranked = F.when(fits, F.struct(F.length(rule).alias("length"), (F.col("rule_verdict") == "block").alias("block"), rule.alias("rule"), F.col("rule_verdict").alias("verdict")))
    best = found.groupBy("page_id", "host", "path", "copies").agg(F.max(ranked).alias("best"))
    result = best.select("page_id", "host", "path", "copies", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(DEFAULT)).alias("verdict"))
    return expand_copies(result, "copies", "copy").drop("copy")
