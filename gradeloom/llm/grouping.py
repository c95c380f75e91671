"""Groups of related records, and splits that keep them together."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.functions.labels import hash_unit, label_key
from gradeloom.session import HOT_ROWS, cut, drop_cut, small, spread_join

#: Bins of (nearly) equal weight per stratum; they are the resolution of the split proportions.
BINS = 100
#: Components that one task balances at a time.
CHUNK = 5_000
#: Tuples of bins that one task combines at a time.
FAN = 500
#: Strata are labels of a fixed list; more are refused, so that the table of bins has a bound (strata x BINS rows).
MAX_STRATA = 5_000


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of edges(a, b): a row per node, `node` and `root` (the smallest node of its component).
    Null ends and loops are left out. Alternating large-star and small-star rounds with a table written after each;
    their number grows with the logarithm of the longest path. Minima are pre-aggregated; the edges of a hub (more than HOT_ROWS)
    get its minimum by broadcast, so they never meet in one task."""
    e = edges.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).filter("u is not null and v is not null and u <> v").distinct()
    # invariant from here on: u < v
    e = cut(e, "cc")
    mark = lambda d: d.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    state = mark(e)
    for _ in range(max_rounds):
        # large star: every larger neighbour of x is linked to the smallest of x and its neighbours
        both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).union(e.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m"), F.count("*").alias("n")).select("x", F.least("x", "m").alias("m"), "n")
        large = _with_least(both.filter("y > x"), least, state.n).select(F.col("m").alias("u"), F.col("y").alias("v")).filter("u <> v").distinct()
        # small star: every smaller neighbour of x, and x, are linked to the smallest neighbour
        least = large.groupBy(F.col("v").alias("x")).agg(F.min("u").alias("m"), F.count("*").alias("n"))
        lower = _with_least(large.select(F.col("v").alias("x"), F.col("u").alias("y")), least, state.n)
        new = lower.filter("y <> m").select(F.col("m").alias("u"), F.col("y").alias("v")).union(least.select(F.col("m").alias("u"), F.col("x").alias("v"))).distinct()
        new = cut(new, "cc")
        # done when all edges are the same as before: then each is a star
        before, state = state, mark(new)
        drop_cut(e)
        e = new
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("v").alias("node"), F.col("u").alias("root")).union(e.select(F.col("u").alias("node"), F.col("u").alias("root"))).distinct()


def _with_least(edges: DataFrame, least: DataFrame, most: int) -> DataFrame:
    """edges(x, y) with the minimum m of x. least: x, m, n (edges of x). most: edges that there are, so no more are at a hub."""
    if most <= HOT_ROWS:
        return edges.join(least.drop("n"), "x")
    hubs = cut(least.filter(F.col("n") > HOT_ROWS).select("x", "m"), "cc-hubs")
    if hubs.isEmpty():
        out = edges.join(least.drop("n"), "x")
        drop_cut(hubs)
        return out
    rest = edges.join(small(hubs).select("x"), "x", "left_anti").join(least.filter(F.col("n") <= HOT_ROWS).drop("n"), "x")
    return rest.unionByName(edges.join(small(hubs), "x"))


def _families(df: DataFrame) -> DataFrame:
    key = lambda c: F.nullif(F.lower(F.trim(c)), F.lit(""))
    return df.select("id", "family_id", key(F.col("family_id")).alias("fam"), F.transform("family_aliases", key).alias("ali"), label_key(F.col("stratum")).alias("stratum"))


def family_groups(df: DataFrame, lone: bool = False) -> DataFrame:
    """A row per family that is tied to another: `node` and `root` (key of its component). Ties: a record's family and each alias;
    aliases are compared without case and surrounding blanks and may name families without rows. With lone, a record without
    family is a node of its own ('id:' and its id) that is tied to each of its aliases. Null or blank aliases tie nothing, repeated
    rows change nothing."""
    f = _families(df)
    own = F.coalesce("fam", F.concat(F.lit("id:"), "id")) if lone else F.col("fam")
    ties = f.filter(own.isNotNull() & (F.size("ali") > 0)).select(own.alias("a"), F.explode("ali").alias("b"))
    return components(ties)


def tied_families(df: DataFrame) -> DataFrame:
    """`group_id`, `family_id`: a row per family with rows, in each group of two or more such families; group_id is the
    smallest family_id of the group. An empty table gives no rows."""
    nodes = family_groups(df)
    rows = df.filter("family_id is not null").select("family_id").distinct().withColumn("node", F.lower(F.trim("family_id")))
    tied = rows.join(nodes, "node").select("root", "family_id")
    per = tied.groupBy("root").agg(F.min("family_id").alias("group_id"), F.count("*").alias("n")).filter("n >= 2")
    return tied.join(per, "root").select("group_id", "family_id")


def difference(tuples: list[tuple[np.ndarray, list[list[int]]]], bins: int) -> tuple[np.ndarray, list[list[int]]]:
    """One tuple of `bins` sums out of many: the two of the largest spread are combined again and again, largest sums with smallest
    sums. A tuple holds its sums, largest first, and the members of each; a short one has empty bins besides."""
    heap = [(-float(s[0] - (s[-1] if len(s) == bins else 0)), i, s, m) for i, (s, m) in enumerate(tuples)]
    heapq.heapify(heap)
    count = len(heap)
    while len(heap) > 1:
        _, _, s1, m1 = heapq.heappop(heap)
        _, _, s2, m2 = heapq.heappop(heap)
        if len(s1) < len(s2):
            s1, m1, s2, m2 = s2, m2, s1, m1
        if len(s1) + len(s2) <= bins:  # they need not share a bin
            sums, members = np.concatenate([s1, s2]), [*m1, *m2]
        else:
            sums = np.concatenate([s1, np.zeros(bins - len(s1))])
            members = [*m1, *([] for _ in range(bins - len(s1)))]
            sums[bins - len(s2) :] += s2[::-1]  # the largest to the smallest
            for k, y in enumerate(reversed(m2)):
                members[bins - len(s2) + k] = members[bins - len(s2) + k] + y
        o = np.argsort(-sums, kind="stable")
        count += 1
        sums = sums[o]
        heapq.heappush(heap, (-float(sums[0] - (sums[-1] if len(sums) == bins else 0)), count, sums, [members[k] for k in o]))
    return (heap[0][2], heap[0][3]) if heap else (np.zeros(0), [])


def largest_differencing(weights: np.ndarray, bins: int) -> np.ndarray:
    """Bin of each weight by the largest-differencing method for many bins: each weight starts as a tuple of its own."""
    _, members = difference([(np.array([w], float), [[i]]) for i, w in enumerate(weights)], bins)
    out = np.zeros(len(weights), int)
    for b, m in enumerate(members):
        out[m] = b
    return out


def combined(per: DataFrame, bins: int, fan: int) -> DataFrame:
    """`stratum`, `chunk`, `bin` to `slot`: the tuples of bins of all chunks of a stratum, differenced into one, at most `fan` tuples
    per task and level. per: stratum, chunk, bin, weight."""
    at = cut(per.select("stratum", "chunk", "bin", "weight", F.col("chunk").alias("_c"), F.col("bin").alias("slot")), "p7level")
    while (at.agg(F.max("_c")).first()[0] or 0) > 0:
        sums = at.groupBy("stratum", "_c", "slot").agg(F.sum("weight").alias("w")).withColumn("_up", F.floor(F.col("_c") / F.lit(fan)).cast("long"))

        def step(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["_c", "w", "slot"], ascending=[True, False, True], kind="stable").reset_index(drop=True)
            tuples = [(g["w"].to_numpy(float), [[i] for i in g.index]) for _, g in pdf.groupby("_c")]
            _, members = difference(tuples, bins)
            to = np.zeros(len(pdf), int)
            for b, m in enumerate(members):
                to[m] = b
            return pdf.assign(_to=to)[["stratum", "_c", "slot", "_up", "_to"]]

        moved = sums.groupBy("stratum", "_up").applyInPandas(step, "stratum string, _c long, slot long, _up long, _to long")
        at = cut(at.join(moved, ["stratum", "_c", "slot"]).select("stratum", "chunk", "bin", "weight", F.col("_up").alias("_c"), F.col("_to").alias("slot")), "p7level")
    return at.select("stratum", "chunk", "bin", "slot", "weight")


def allocate(bins: pd.DataFrame, parts: dict[str, float]) -> list[str]:
    """Split of each bin (columns stratum, weight): heaviest bins first, each to the split whose shortfall, in its
    stratum and overall, is the largest share of its goal."""
    names = list(parts)
    share = np.array([parts[p] for p in names])
    share = share / share.sum()
    total = bins["weight"].sum()
    per = bins.groupby("stratum")["weight"].sum()
    all_in, in_stratum = np.zeros(len(names)), {s: np.zeros(len(names)) for s in per.index}
    out = [""] * len(bins)
    for i in np.argsort(-bins["weight"].to_numpy(), kind="stable"):
        s, w = bins["stratum"].iloc[i], bins["weight"].iloc[i]
        lack = (share * per[s] - in_stratum[s]) / max(per[s], 1) + (share * total - all_in) / max(total, 1)
        # a bin that fits into what is lacking goes where most is lacking in relation to the goal
        k = int(np.argmax(lack / np.maximum(share, 1e-12)))
        out[i] = names[k]
        all_in[k] += w
        in_stratum[s][k] += w
    return out


def grouped_split(df: DataFrame, parts: dict[str, float] | None = None, seed: str = "p7") -> DataFrame:
    """A row per id: id, group (key of its component), new_split. All records tied by family_id and family_aliases get one split; the
    proportions `parts` are met overall and by stratum as far as the weights of whole groups allow.

    Method: components, then largest-differencing balance: per main stratum of a component, weights are combined into
    BINS equal bins (in chunks of about CHUNK components, whose tuples of bins are differenced in turn), and whole bins go to
    the splits. A component that outweighs a bin makes a heavy bin of its own, which is placed first.

    Repeated deliveries of an id count once; null ids are dropped; a record without family is a group of its own unless it
    names families, to which it is then tied; a null stratum is a stratum. Empty input gives no rows."""
    parts = parts or {"train": 0.8, "validation": 0.1, "test": 0.1}
    spark = df.sparkSession
    f = _families(df.filter("id is not null"))
    rows = f.groupBy("id").agg(F.min(F.struct("fam", F.coalesce("stratum", F.lit("")).alias("stratum"))).alias("x")).select("id", F.coalesce("x.fam", F.concat(F.lit("id:"), "id")).alias("node"), "x.stratum")
    nodes = family_groups(df, lone=True)
    # families and strata first, so that a hot family is joined as a few rows
    fam = rows.groupBy("node", "stratum").agg(F.count("*").alias("n"))
    fam = cut(fam.join(nodes, "node", "left").select("node", "stratum", "n", F.coalesce("root", "node").alias("root")), "p7fam")
    weights = fam.groupBy("root", "stratum").agg(F.sum("n").alias("n")).groupBy("root").agg(F.sum("n").alias("w"), F.max_by("stratum", F.struct("n", "stratum")).alias("stratum"))
    weights = cut(weights, "p7w")
    sizes = weights.groupBy("stratum").agg(F.ceil(F.count("*") / F.lit(CHUNK)).alias("chunks"))
    if sizes.limit(MAX_STRATA + 1).count() > MAX_STRATA:
        raise ValueError(f"more than {MAX_STRATA} strata")
    weights = weights.join(small(sizes), "stratum").withColumn("chunk", (hash_unit(F.lit(seed), "root") % F.col("chunks")).cast("long")).drop("chunks")

    def balance(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("root", kind="stable")
        return pd.DataFrame({"root": pdf["root"], "stratum": pdf["stratum"], "chunk": pdf["chunk"], "bin": largest_differencing(pdf["w"].to_numpy(float), BINS), "w": pdf["w"]})

    binned = cut(weights.groupBy("stratum", "chunk").applyInPandas(balance, "root string, stratum string, chunk long, bin long, w long"), "p7bins")
    per = binned.groupBy("stratum", "chunk", "bin").agg(F.sum("w").alias("weight"))
    per = combined(per, BINS, FAN)
    slots = per.groupBy("stratum", "slot").agg(F.sum("weight").alias("weight")).toPandas().sort_values(["stratum", "slot"], ignore_index=True)  # at most MAX_STRATA x BINS rows
    slots["new_split"] = allocate(slots, parts) if len(slots) else []
    placed = spark.createDataFrame([(r.stratum, int(r.slot), r.new_split) for r in slots.itertuples()], "stratum string, slot int, new_split string")
    final = per.join(small(placed), ["stratum", "slot"]).select("stratum", "chunk", "bin", "new_split")
    groups = binned.join(small(final), ["stratum", "chunk", "bin"]).select("root", "new_split")
    by_node = cut(fam.select("node", "root").distinct().join(groups, "root").select("node", F.col("root").alias("group"), "new_split"), "p7nodes")
    return spread_join(rows.select("id", "node"), by_node, "node", "id").select("id", "group", "new_split")


def broken_ties(df: DataFrame, assigned: DataFrame) -> DataFrame:
    """One row: records assigned, and families and ties (of a record and a family that it belongs to or names) that lie in more
    than one new split; none may."""
    f = _families(df.filter("id is not null"))
    names = f.select("id", F.explode(F.array_distinct(F.filter(F.concat(F.array("fam"), F.coalesce("ali", F.array().cast("array<string>"))), lambda k: k.isNotNull()))).alias("name")).distinct()
    per = spread_join(names, assigned.select("id", "new_split"), "id", "name").groupBy("name").agg((F.min("new_split") != F.max("new_split")).alias("crossed"))
    return assigned.agg(F.count("*").alias("records"), F.countDistinct("id").alias("ids")).crossJoin(per.agg(F.count_if("crossed").alias("crossed")))  # two single rows


def split_report(df: DataFrame, assigned: DataFrame) -> DataFrame:
    """Per stratum ('*' for all): ids per new split and their share."""
    s = _families(df.filter("id is not null")).groupBy("id").agg(F.min(F.coalesce("stratum", F.lit(""))).alias("stratum"))
    both = s.join(assigned, "id").groupBy("stratum", "new_split").agg(F.count("*").alias("records"))
    every = both.groupBy("new_split").agg(F.sum("records").alias("records")).select(F.lit("*").alias("stratum"), "new_split", "records")
    out = both.unionByName(every)
    return out.withColumn("share", F.col("records") / F.sum("records").over(Window.partitionBy("stratum")))
