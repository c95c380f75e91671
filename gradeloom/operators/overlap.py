"""Exact and near overlap of prompts, by keys and by sketches."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.functions.ids import with_shingles
from gradeloom.session import cut

#: Jaccard similarity of 5-word shingles from which texts count as near: the reference's against held-out prompts, and that of classes.
NEAR, NEAR_CLASS = 0.85, 0.8
#: The most frequent shingles, so many at most, are known to every task and come last in the order of the prefix filter.
FREQUENT = 1 << 18
#: Texts that must hold a shingle for it to be one of them.
LEAST_FREQUENT = 16


def near_pairs(left: DataFrame, right: DataFrame, ident: str, text: str, least: float = NEAR, ideographs: bool = False) -> DataFrame:
    """`a` (left id), `b` (right id), `similarity`: all pairs of texts whose 5-word shingles have a Jaccard similarity of
    at least `least`. Equal texts are compared once, so copies never multiply candidates: the result has a row per pair of
    texts' representatives (the smallest id of each text). Null texts match nothing, nor do those of fewer than 10 shingles,
    unless ideographs is set (see with_shingles).

    Candidates come from a prefix filter: two such sets of shingles must share one of the first n - ceil(least n) + 1 of
    either in any common order. The order is by frequency, rarest first: shingles are counted over all texts, and the
    FREQUENT most frequent ones (a table of bounded size for the tasks) come last by their counts, the others in the order of
    their hashes. So frequent phrases are no join keys, and no pair is missed."""
    def rep(df: DataFrame, name: str) -> DataFrame:
        one = df.filter(F.col(text).isNotNull()).groupBy(F.sha2(text, 256).alias("_t")).agg(F.min(ident).alias(name), F.min(text).alias("_text"))
        return cut(with_shingles(one, "_text", "sh", ideographs).select(name, "sh").filter("sh is not null"), "near")

    a = rep(left, "a")
    b = a.withColumnRenamed("a", "b") if right is left else rep(right, "b")
    every = a.select(F.explode("sh").alias("k")) if right is left else a.select(F.explode("sh").alias("k")).union(b.select(F.explode("sh").alias("k")))
    top = every.groupBy("k").count().filter(F.col("count") >= LEAST_FREQUENT).orderBy(F.desc("count"), "k").limit(FREQUENT).collect()
    top.sort(key=lambda r: r.k)
    sent = left.sparkSession.sparkContext.broadcast((np.array([r.k for r in top], np.int64), np.array([r["count"] for r in top], np.int64)))

    def prefixes(d: DataFrame, name: str) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            known, counts = sent.value
            for pdf in batches:
                ids, keys, sizes = [], [], []
                for i, sh in zip(pdf[name], pdf["sh"]):
                    s = np.asarray(sh, np.int64)
                    n = len(s) - math.ceil(least * len(s) - 1e-9) + 1
                    if len(known):
                        at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                        s = s[np.lexsort((s, np.where(known[at] == s, counts[at], 0)))]
                    ids.extend([i] * n)
                    keys.append(s[:n])
                    sizes.extend([len(s)] * n)
                yield pd.DataFrame({name: pd.Series(ids, dtype=pdf[name].dtype), "k": np.concatenate(keys) if keys else np.zeros(0, np.int64), f"n_{name}": np.array(sizes, np.int32)})

        return d.select(name, "sh").mapInPandas(run, f"{name} {d.schema[name].dataType.simpleString()}, k long, n_{name} int")

    fits = (F.col("n_a") >= F.col("n_b") * least) & (F.col("n_b") >= F.col("n_a") * least)
    pairs = prefixes(a, "a").join(prefixes(b, "b"), "k").filter(fits)
    pairs = (pairs.filter("a < b") if right is left else pairs).select("a", "b").distinct()
    both = pairs.join(a.select("a", F.col("sh").alias("x")), "a").join(b.select("b", F.col("sh").alias("y")), "b")
    same = F.size(F.array_intersect("x", "y"))
    return both.withColumn("similarity", same / (F.size("x") + F.size("y") - same)).filter(F.col("similarity") >= least).select("a", "b", "similarity")


def near_classes(df: DataFrame, ident: str, text: str, least: float = NEAR_CLASS) -> DataFrame:
    """A row per text class member: ident, `class_id` (smallest id among equal texts) and `links` (near texts of the class).
    Short texts are compared too, and each ideograph is a word."""
    member = df.filter(F.col(text).isNotNull()).groupBy(F.sha2(text, 256).alias("_t")).agg(F.min(ident).alias("class_id"))
    pairs = near_pairs(df, df, ident, text, least, ideographs=True)
    links = pairs.select("a").union(pairs.select("b")).groupBy(F.col("a").alias("class_id")).agg(F.count("*").alias("links"))
    rows = df.filter(F.col(text).isNotNull()).select(F.col(ident), F.sha2(text, 256).alias("_t"))
    return rows.join(member, "_t").join(links, "class_id", "left").select(ident, "class_id", F.coalesce("links", F.lit(0)).alias("links"))


def held_out_filter(candidates: DataFrame, held: DataFrame, keys: str, ident: str) -> DataFrame:
    """Candidates that share none of their keys (an array column) with a held-out row."""
    used = held.select(F.explode(keys).alias("k")).distinct()
    hit = candidates.select(ident, F.explode(keys).alias("k")).join(used, "k", "left_semi").select(ident).distinct()
    return candidates.join(hit, ident, "left_anti")


def overlap_counts(df: DataFrame, split: str, keys: str) -> DataFrame:
    """Number of keys that two splits share, a row per pair of splits (also 0). Keys are reduced to the set of their splits first."""
    sets = df.select(F.explode(keys).alias("k"), split).groupBy("k").agg(F.sort_array(F.collect_set(split)).alias("s"))
    pair = sets.filter("size(s) > 1").select(F.explode(F.expr("flatten(transform(s, (x, i) -> transform(slice(s, i + 2, size(s)), y -> struct(x as a, y as b))))")).alias("p"))
    got = pair.groupBy("p.a", "p.b").agg(F.count("*").alias("shared"))
    names = df.select(split).distinct()
    grid = names.select(F.col(split).alias("a")).join(names.select(F.col(split).alias("b")), F.col("a") < F.col("b"))
    return grid.join(got, ["a", "b"], "left").select("a", "b", F.coalesce("shared", F.lit(0)).alias("shared"))
