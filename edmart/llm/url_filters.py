"""URL filters: host and path rules, then naive Bayes over segmented host and path tokens.

A unigram model counted from the pages' own words splits concatenated host names by
Viterbi. Its vocabulary is never gathered: the substrings of the distinct host labels
are joined with the word counts. Naive Bayes counts hashed tokens of all labelled pages;
its weights are one array of fixed size.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edmart.llm.shared import let, stored
from edmart.operators.joins import lookup_join

BUCKETS = 16384
LONGEST_WORD = 20
# Rules of the registered query: (verdict, host/path prefix). Fixed values.
RULES = [
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for NULL or without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; NULLs without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: len(r[1])):  # the longest is tested first
        domain, slash, prefix = text.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit(f".{domain}"))) & F.startswith(path, F.lit(slash + prefix))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def word_counts(pages: DataFrame, longest: int = LONGEST_WORD) -> DataFrame:
    """(word, n): lower-case letter runs in the text of all pages, tags taken out."""
    text = F.lower(F.regexp_replace(F.coalesce("html", F.lit("")), "<[^>]*>", " "))
    each = pages.select(F.explode_outer(F.split(text, r"[^\p{L}]+")).alias("word"))
    each = each.filter(F.length("word").between(1, longest))
    return each.groupBy("word").agg(F.count("*").alias("n"))


def host_labels(hosts: DataFrame) -> DataFrame:
    """(host, at, name): the letter runs of each host in order, other signs taken out."""
    return hosts.select("host", F.posexplode(F.array_remove(F.split("host", r"[^\p{L}]+"), "")).alias("at", "name"))


def split_name(name: str, known: dict[tuple[int, int], int], total: int, longest: int = LONGEST_WORD) -> list[str]:
    """The most likely split of ``name``; ``known`` has the counts of its substrings by (start, length).

    An unseen word of length L has the weight ``10 / (total * 10**L)``.
    """
    best: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(name) + 1):
        found = []
        for start in range(max(0, end - longest), end):
            n = known.get((start, end - start))
            gain = math.log(n / total) if n else math.log(10 / total) - (end - start) * math.log(10)
            found.append((best[start][0] + gain, start))
        best.append(max(found))
    words, end = [], len(name)
    while end:
        start = best[end][1]
        words.append(name[start:end])
        end = start
    return words[::-1]


def segmented(hosts: DataFrame, counts: DataFrame, longest: int = LONGEST_WORD) -> DataFrame:
    """(host, host_tokens) of each distinct ``host``; a host without letters has none."""
    total = max(1, counts.agg(F.sum("n").alias("n")).first()["n"] or 1)
    labels = host_labels(hosts)
    names = labels.select("name").distinct()
    starts = F.sequence(F.lit(1), F.length("name"))
    lengths = F.sequence(F.lit(1), F.least(F.lit(longest), F.length("name") - F.col("start") + 1))
    parts = names.select("name", F.explode(starts).alias("start"))
    parts = parts.select("name", "start", F.explode(lengths).alias("len"))
    parts = parts.withColumn("word", F.expr("substring(name, start, len)"))
    # each distinct substring meets the vocabulary once
    seen = parts.select("word").distinct().join(counts, "word")
    # a name has at most 20 substrings per letter
    found = (
        parts.join(seen, "word")
        .groupBy("name")
        .agg(F.collect_list(F.struct((F.col("start") - 1).alias("s"), F.col("len").alias("l"), "n")).alias("known"))
    )

    @F.pandas_udf("array<string>")
    def split(name: pd.Series, known: pd.Series) -> pd.Series:
        return pd.Series(
            [
                split_name(x, {(k["s"], k["l"]): k["n"] for k in ([] if own is None else own)}, total, longest)
                for x, own in zip(name, known)
            ]
        )

    words = names.join(found, "name", "left").select("name", split("name", "known").alias("words"))
    per_host = (
        labels.join(words, "name")
        .groupBy("host")
        .agg(F.array_sort(F.collect_list(F.struct("at", "words"))).alias("parts"))
        .select("host", F.flatten(F.transform("parts", lambda p: p["words"])).alias("host_tokens"))
    )
    return hosts.join(per_host, "host", "left").withColumn("host_tokens", F.coalesce("host_tokens", F.array()))


def path_tokens(path: Column) -> Column:
    """Lower-case letter runs of the path, and ``0`` for each run of digits."""
    plain = F.regexp_replace(F.lower(path), r"\p{N}+", " 0 ")
    return F.array_remove(F.split(plain, r"[^\p{L}0]+"), "")


def token_weights(examples: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row (prior, weights) from ``examples`` (blocked, bucket list): add-one smoothed log-odds of block.

    Without examples of both classes all weights are 0 and the prior is below 0: allow.
    """
    classes = examples.agg(F.count_if("blocked").alias("bad"), F.count_if(~F.col("blocked")).alias("good"))
    counts = (
        examples.select("blocked", F.explode_outer("tokens").alias("bucket"))
        .filter("bucket IS NOT NULL")
        .groupBy("bucket")
        .agg(F.count_if("blocked").alias("bad"), F.count_if(~F.col("blocked")).alias("good"))
    )
    full = (
        examples.sparkSession.range(buckets)
        .select(F.col("id").cast("int").alias("bucket"))
        .join(counts, "bucket", "left")
        .na.fill(0, ["bad", "good"])
    )
    table = full.agg(  # ``buckets`` rows, whatever the number of pages
        F.array_sort(F.collect_list(F.struct("bucket", "bad", "good"))).alias("cells"),
        F.sum("bad").alias("all_bad"),
        F.sum("good").alias("all_good"),
    )
    odds = F.transform(
        "cells",
        lambda c: F.ln((c["bad"] + 1) / (F.col("all_bad") + buckets))
        - F.ln((c["good"] + 1) / (F.col("all_good") + buckets)),
    )
    row = classes.first()
    both = row["bad"] and row["good"]
    prior = math.log(row["bad"] / row["good"]) if both else -1.0
    empty = F.array_repeat(F.lit(0.0), buckets)
    return table.select(F.struct(F.lit(prior).alias("prior"), (odds if both else empty).alias("odds")).alias("model"))


def filter_urls(
    pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]] = RULES, buckets: int = BUCKETS
) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row of ``pages`` (page_id, url, html).

    ``labels`` (doc_id = page_id, quality, toxic) teach naive Bayes: toxic 1 or quality 0 is a page
    to block, NULLs count as not toxic and good. ``score`` is the log-odds of block, which
    decide where no rule fits. A NULL url has empty host and path and is judged by the prior.
    Repeated rows are judged each; a page that has several labels is to block if one says so.
    """
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    hosts = segmented(urls.select("host").distinct(), stored(word_counts(pages), "url-words"))
    tokens = F.concat("host_tokens", path_tokens(F.col("path")))
    hashed = F.transform(tokens, lambda t: F.pmod(F.xxhash64(t), F.lit(buckets)).cast("int"))
    urls = lookup_join(urls, hosts, "host").select("page_id", "host", "path", "host_tokens", hashed.alias("tokens"))
    urls = stored(urls, "url-tokens")
    blocked = (F.coalesce(F.col("toxic") == 1, F.lit(False))) | F.coalesce(F.col("quality") == 0, F.lit(False))
    taught = labels.select(F.col("doc_id").alias("page_id"), blocked.alias("blocked")).groupBy("page_id")
    examples = urls.select("page_id", "tokens").join(taught.agg(F.bool_or("blocked").alias("blocked")), "page_id")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = urls.withColumn("model", token_weights(examples, buckets).scalar())
    odds = let(
        F.col("model"),
        lambda m: m["prior"] + F.aggregate("tokens", F.lit(0.0), lambda acc, t: acc + F.get(m["odds"], t)),
    )
    judged = judged.withColumn("score", odds).drop("model")
    by_odds = F.when(F.col("score") > 0, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_odds).alias("verdict"), "score", "host_tokens"
    )
