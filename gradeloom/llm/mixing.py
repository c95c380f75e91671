"""Mixing sources to target weights."""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.functions.labels import hash_unit, label_key
from gradeloom.session import cut, small

#: Fixed value: the published pattern that splits text before the merges of a rank file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def with_sizes(df: DataFrame, keys: list[str], text: str, ranks: str) -> DataFrame:
    """keys of df and `tokens`: tokens of the whole text under the public byte-level vocabulary in the rank file `ranks`
    (read by each task; the path must exist on every executor). Null texts hold 0 tokens."""
    schema = df.select(*keys).schema.add("tokens", "long")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        with open(ranks, "rb") as f:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        coder = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})
        for pdf in batches:
            out = pdf[keys].copy()
            out["tokens"] = [len(coder.encode_ordinary(t)) if t else 0 for t in pdf["_text"]]
            yield out

    return df.select(*keys, F.col(text).alias("_text")).mapInPandas(run, schema)


def capped_mean(mu: float, cap: int) -> float:
    """Mean of min(X, cap) for a Poisson X of mean mu."""
    p, below, got = math.exp(-mu), 0.0, 0.0
    for k in range(cap):
        got += k * p
        below += p
        p *= mu / (k + 1)
    return got + cap * (1 - below)


def rate_for(mean: float, cap: int) -> float:
    """The Poisson mean whose counts, capped at cap, have the given mean (< cap)."""
    low, high = 0.0, 1.0
    while capped_mean(high, cap) < mean and high < 600:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if capped_mean(mid, cap) < mean else (low, mid)
    return (low + high) / 2


def thresholds(mu: float, cap: int) -> list[float]:
    """P(X <= k) for k = 0 .. cap-1: a uniform u gives the count of the values that are <= u."""
    p, total, out = math.exp(-mu), 0.0, []
    for k in range(cap):
        total += p
        out.append(min(total, 1.0))
        p *= mu / (k + 1)
    return out


def mix(documents: DataFrame, targets: DataFrame, ranks: str, seed: str = "p9", keep_shares: bool = False) -> tuple[DataFrame, DataFrame]:
    """(chosen, report). Method: Poisson replication. A source's mean repetition rate is target_weight x all tokens / its
    tokens; a count per document comes from inverting the Poisson distribution at the hash of its id, never above
    max_repeats (the mean is raised so that the capped counts meet the rate). A source that cannot meet its weight even
    with max_repeats copies of everything falls short and is used that often. The others keep to their weight of all tokens, so
    their share of a mix that falls short is larger; with keep_shares the total is instead the largest that lets every source with
    documents keep its weight, and what sources without documents lack is missing from it.

    Sources are equal when they differ only in case, blanks, hyphens and underscores. Documents of other or no sources
    count in the total but are not chosen; null texts hold 0 tokens; null ids are dropped; repeated deliveries of an id
    count once. chosen: doc_id, source (as in targets), copies (at least 1), tokens (of one copy). report, a row per
    target: source, target_weight, max_repeats, documents, tokens, rate, wanted, used, share (of the mix), share_of_total (of the
    tokens of all documents, which target_weight speaks of), falls_short. Targets are a
    small fixed table (collected; one row per source)."""
    spark = documents.sparkSession
    sized = with_sizes(documents.filter("doc_id is not null").select("doc_id", "source", "text"), ["doc_id", "source"], "text", ranks)
    sized = cut(sized.groupBy("doc_id").agg(F.max(F.struct("tokens", "source")).alias("x")).select("doc_id", label_key(F.col("x.source")).alias("key"), F.col("x.tokens").alias("tokens")), "p9sizes")
    want = targets.select("source", "target_weight", "max_repeats", label_key(F.col("source")).alias("key")).collect()
    total = sized.agg(F.sum("tokens").alias("t")).first().t or 0
    have = {r.key: (r.n, r.t) for r in sized.filter(F.col("key").isin([w.key for w in want])).groupBy("key").agg(F.count("*").alias("n"), F.sum("tokens").alias("t")).collect()}
    plan, facts = [], []
    size = total
    if keep_shares:
        size = min([total, *(have[w.key][1] * (w.max_repeats or 0) / w.target_weight for w in want if w.target_weight and have.get(w.key, (0, 0))[1])])
    for w in want:
        n, tokens = have.get(w.key, (0, 0))
        wanted, cap = (w.target_weight or 0.0) * total, max(0, w.max_repeats or 0)
        rate = min(wanted, (w.target_weight or 0.0) * size) / tokens if tokens else 0.0
        short = tokens * cap < wanted
        steps = [0.0] * cap if rate >= cap else thresholds(rate_for(rate, cap), cap) if rate > 0 else [1.0] * cap
        plan.append((w.key, w.source, steps))
        facts.append((w.key, w.source, w.target_weight, w.max_repeats, n, tokens, rate, wanted, short))
    plan = spark.createDataFrame(plan, "key string, name string, steps array<double>")
    u = hash_unit(F.lit(seed), F.col("doc_id").cast("string")) / F.lit(2.0**52)
    chosen = sized.join(F.broadcast(plan), "key").withColumn("u", u).withColumn("copies", F.size(F.filter("steps", lambda s: s <= F.col("u"))))  # plan: one row per target
    chosen = chosen.filter("copies > 0").select("doc_id", F.col("name").alias("source"), "copies", "tokens")
    used = {r.source: r.t for r in chosen.groupBy("source").agg(F.sum(F.col("copies") * F.col("tokens")).alias("t")).collect()}
    every = sum(used.values()) or 1
    report = [(*f[1:8], used.get(f[1], 0), used.get(f[1], 0) / every, used.get(f[1], 0) / (total or 1), f[8]) for f in facts]
    return chosen, spark.createDataFrame(report, "source string, target_weight double, max_repeats int, documents long, tokens long, rate double, wanted double, used long, share double, share_of_total double, falls_short boolean")


def shuffled_copies(chosen: DataFrame, seed: str = "p9") -> DataFrame:
    """A row per copy, in global random order: doc_id, source, copy (from 0), place (sort key; rows are range-partitioned
    and sorted by it). The order depends on ids and the seed only."""
    rows = chosen.select("doc_id", "source", "tokens", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
    return rows.withColumn("place", hash_unit(F.lit(seed), F.lit("order"), F.col("doc_id").cast("string"), F.col("copy").cast("string"))).orderBy("place", "doc_id", "copy")
