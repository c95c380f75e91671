import os
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradeloom.llm import grouping as G
from gradeloom.llm import mixing as M
from gradeloom.llm import queries as Q
from gradeloom.llm.wordpiece import LongestMatch, repository, token_budget


def union_find(edges):
    p = {}

    def find(x):
        p.setdefault(x, x)
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        p[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(p)}


def test_components_against_union_find(spark):
    r = random.Random(1)
    edges = [(f"n{r.randrange(150):03d}", f"n{r.randrange(150):03d}") for _ in range(90)] + [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(40)] + [("hub", f"h{i}") for i in range(60)] + [("x", "x"), (None, "y")]
    df = spark.createDataFrame(edges, "a string, b string")
    got = {x.node: x.root for x in G.components(df).collect()}
    assert got == union_find([(a, b) for a, b in edges if a and b and a != b])
    assert G.components(df.limit(0)).count() == 0


FAM = "id string, family_id string, family_aliases array<string>, stratum string, root string"


def test_ties_and_split(spark):
    rows = [("1", "A", [" b "], "s", "x"), ("2", "B", None, "s", "x"), ("3", "C", ["ghost"], None, "x"), ("4", "D", ["GHOST", None, ""], "s", "x"), ("5", "E", [], "s", "x"), ("6", None, ["A"], "s", "x"), ("1", "A", [" b "], "s", "x"), (None, "Z", None, "s", "x")]
    df = spark.createDataFrame(rows, FAM)
    assert sorted((x.group_id, x.family_id) for x in G.tied_families(df).collect()) == [("A", "A"), ("A", "B"), ("C", "C"), ("C", "D")]
    assert G.tied_families(df.limit(0)).count() == 0 and G.grouped_split(df.limit(0)).count() == 0
    got = {x.id: x.new_split for x in G.grouped_split(df).collect()}
    # 6 has no family, but names A
    assert set(got) == set("123456") and got["1"] == got["2"] == got["6"] and got["3"] == got["4"]
    b = G.broken_ties(df, G.grouped_split(df)).first()
    assert (b.records, b.ids, b.crossed) == (6, 6, 0)
    wrong = G.grouped_split(df).withColumn("new_split", F.col("id"))
    assert G.broken_ties(df, wrong).first().crossed == 3


def test_split_proportions(spark):
    rows = [(f"i{i}", f"f{i % 1500}" if i % 3 else "hot", [f"f{i % 1500 + 1}"] if i % 40 == 0 else None, f"s{i % 3}", "x") for i in range(6000)]
    df = spark.createDataFrame(rows, FAM)
    out = G.grouped_split(df)
    parts = defaultdict(set)
    fam = {r[0]: r[1] for r in rows}
    for x in out.collect():
        parts[fam[x.id]].add(x.new_split)
    assert max(map(len, parts.values())) == 1
    share = {x.new_split: x.share for x in G.split_report(df, out).filter("stratum = '*'").collect()}
    assert abs(share["train"] - 0.8) < 0.05 and abs(share["test"] - 0.1) < 0.05


def test_largest_differencing():
    w = np.random.default_rng(3).integers(1, 50, 3000).astype(float)
    b = G.largest_differencing(w, 20)
    sums = np.bincount(b, w, 20)
    assert sums.max() - sums.min() <= 2 and len(b) == 3000
    assert len(G.largest_differencing(np.zeros(0), 5)) == 0
    # the textbook case: 8 7 6 5 4 into two bins of 16 and 14
    two = np.bincount(G.largest_differencing(np.array([8.0, 7, 6, 5, 4]), 2), [8, 7, 6, 5, 4])
    assert sorted(two) == [14, 16] and sorted(np.bincount(G.largest_differencing(np.array([5.0, 1]), 4), [5, 1], 4)) == [0, 0, 1, 5]


def test_bins_of_chunks_are_differenced(spark):
    r = np.random.default_rng(5)
    rows = [(s, c, b, int(r.integers(1, 90))) for s in "xy" for c in range(7) for b in range(10)]
    df = spark.createDataFrame(rows, "stratum string, chunk long, bin long, weight long")
    at = G.combined(df, 10, 3).toPandas()
    assert len(at) == len(rows) and set(at["slot"]) == set(range(10))
    for _, g in at.groupby("stratum"):
        sums = g.groupby("slot")["weight"].sum()
        assert (g.groupby(["chunk", "slot"]).size() == 1).all() and sums.max() - sums.min() <= 0.12 * sums.mean()
    assert G.combined(df.limit(0), 10, 3).count() == 0


def test_hub_beyond_the_hot_limit(spark, monkeypatch):
    monkeypatch.setattr(G, "HOT_ROWS", 20)
    edges = [("hub", f"h{i:03d}") for i in range(70)] + [(f"h{i:03d}", f"k{i:03d}") for i in range(0, 70, 7)] + [("p", "q")]
    got = {x.node: x.root for x in G.components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == union_find(edges)


RANKS = Q.RANKS


@pytest.mark.skipif(not os.path.exists(RANKS), reason="no vocabulary")
def test_mix(spark):
    rows = [(i, "word " * (20 + i % 30), ["big", "Small-One", "tiny"][0 if i % 10 < 7 else 1 if i % 10 < 9 else 2]) for i in range(2000)] + [(5000, None, "big"), (5001, "", "big"), (None, "x", "big"), (5002, "other words", None), (1, "word " * 21, "big")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    t = spark.createDataFrame([("big", 0.4, 2), ("small_one", 0.3, 3), ("TINY", 0.3, 2), ("gone", 0.0, 2)], "source string, target_weight double, max_repeats int")
    chosen, report = M.mix(df, t, RANKS)
    r = {x.source: x for x in report.collect()}
    assert [r[s].falls_short for s in ("big", "small_one", "TINY", "gone")] == [False, False, True, False]
    assert abs(r["big"].used / r["big"].wanted - 1) < 0.08 and abs(r["small_one"].used / r["small_one"].wanted - 1) < 0.1 and r["TINY"].used == 2 * r["TINY"].tokens
    most = {x.source: x.m for x in chosen.groupBy("source").agg(F.max("copies").alias("m")).collect()}
    assert most["big"] <= 2 and most["small_one"] <= 3 and most["TINY"] == 2
    a = [(x.doc_id, x.copy) for x in M.shuffled_copies(chosen).collect()]
    b = [(x.doc_id, x.copy) for x in M.shuffled_copies(M.mix(df.repartition(5), t, RANKS)[0]).collect()]
    assert a == b and len(a) == len(set(a)) == sum(x.copies for x in chosen.collect())
    assert M.mix(df.limit(0), t, RANKS)[0].count() == 0
    kept = {x.source: x for x in M.mix(df, t, RANKS, keep_shares=True)[1].collect()}
    assert kept["TINY"].falls_short and all(abs(kept[s].share - w) < 0.04 for s, w in (("big", 0.4), ("small_one", 0.3), ("TINY", 0.3)))
    assert abs(r["big"].share_of_total - 0.4) < 0.04 and r["big"].share - r["big"].share_of_total > 0.02


def test_poisson_inversion():
    for cap, mean in ((1, 0.3), (2, 1.5), (4, 3.9), (3, 0.01)):
        mu = M.rate_for(mean, cap)
        assert abs(M.capped_mean(mu, cap) - mean) < 1e-6
        steps = M.thresholds(mu, cap)
        u = (np.arange(100_000) + 0.5) / 100_000
        assert abs(np.searchsorted(steps, u, side="right").mean() - mean) < 0.01


def greedy(word, pieces):
    at, n = 0, 0
    while at < len(word):
        for end in range(len(word), at, -1):
            if ("##" if at else "") + word[at:end] in pieces:
                at, n = end, n + 1
                break
        else:
            return 1
    return n


def test_longest_match_against_greedy():
    r = random.Random(4)
    for _ in range(60):
        pieces = {("##" if r.random() < 0.5 else "") + "".join(r.choice("abc") for _ in range(r.randrange(1, 5))) for _ in range(r.randrange(1, 25))}
        m = LongestMatch(pieces)
        for _ in range(60):
            w = "".join(r.choice("abcd" if r.random() < 0.1 else "abc") for _ in range(r.randrange(1, 12)))
            assert m.count(w) == greedy(w, pieces), (w, pieces)


def test_longest_match_against_library():
    from tokenizers import Tokenizer, models

    pieces = ["[UNK]", "un", "##aff", "##able", "##a", "##f", "a", "b", "##b", "##le"]
    t = Tokenizer(models.WordPiece({p: i for i, p in enumerate(pieces)}, unk_token="[UNK]", max_input_chars_per_word=100))
    m = LongestMatch(pieces)
    for w in ("unaffable", "unaffabl", "ab", "aab", "b", "zz", "a" * 101, "abbbble"):
        assert m.count(w) == len(t.encode(w).tokens), w


def test_budget(spark):
    s = spark.createDataFrame([("1", '{"repo": "a/b"}', "en-US", "Math ", "t", [("user", "ab, b")]), ("1", '{"repo": "a/b"}', "en-US", "Math ", "t", [("user", "ab, b")]), ("2", "bare", None, None, None, None), (None, "x", None, None, None, None)],
                              "id string, source string, language string, domain string, task string, messages array<struct<role string, content string>>")
    d = spark.createDataFrame([(1, "S-1", "German", "x", "a b"), (2, "s 1", "de", "x", None), (None, "q", None, None, "a")], "doc_id long, source string, lang string, domain string, text string")
    p = spark.createDataFrame([("[UNK]",), ("a",), ("##b",), ("b",), (None,)], "piece string")
    got = {(x.table, x.source, x.language, x.domain): (x.rows, x.tokens) for x in token_budget(s, d, p).collect()}
    assert got == {("splits", "a/b", "en", "math"): (1, 4), ("splits", "bare", "unknown", "unknown"): (1, 0), ("documents", "s1", "de", "x"): (2, 2)}
    assert token_budget(s.limit(0), d.limit(0), p).count() == 0
    assert s.select(repository(F.col("source")).alias("r")).distinct().count() == 3 and Counter()[0] == 0
