"""Sampling: proportions over several label columns, and samples that stay when data grows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.functions.labels import hash_unit, label_key
from gradeloom.session import cut, small

#: One inclusion probability of 1 in the fixed-point prefix sums; with longs, sums hold for 9e10 rows.
UNIT = 10**8
#: Rows of one cell that one task orders; larger cells are cut by hash range.
CHUNK = 50_000
#: No inclusion probability is less than this share of the overall rate.
LEAST_RATE = 0.05
#: The fit works on one row per combination of target labels; more cells than this are refused, not truncated.
MAX_CELLS = 500_000


def least_shortfall(counts: np.ndarray, member: list[np.ndarray], goals: list[np.ndarray], size: float, rounds: int = 1_500) -> np.ndarray:
    """Inclusion probability per cell: they add up to `size` rows, and the expected rows that categories lack, over all
    levels, are the fewest possible. counts: rows per cell. member[l][c]: category of cell c at level l, -1 for none.
    goals[l]: wanted rows. A linear programme, solved by primal-dual steps with diagonal step sizes; among the many
    solutions, that near one rate for all. No probability falls below LEAST_RATE of that rate, however targets conflict."""
    total = counts.sum()
    if not total or size >= total:
        return np.ones(len(counts))
    rate = size / total
    low = LEAST_RATE * rate

    def onto(q: np.ndarray) -> np.ndarray:
        """The nearest point that keeps the size: all are shifted by one amount, within their bounds."""
        a, b = low - q.max(), 1 - q.min()
        for _ in range(40):
            mid = (a + b) / 2
            a, b = (mid, b) if (np.clip(q + mid, low, 1) * counts).sum() < size else (a, mid)
        return np.clip(q + (a + b) / 2, low, 1)

    inside = [of >= 0 for of in member]
    held = [np.maximum(np.bincount(of[i], counts[i], len(g)), 1.0) for of, i, g in zip(member, inside, goals)]
    p = onto(np.full(len(counts), rate))
    lean = p
    price = [np.zeros(len(g)) for g in goals]
    mean, seen = np.zeros(len(counts)), 0
    for step in range(rounds):
        for of, i, g, h, y in zip(member, inside, goals, held, price):
            y += (g - np.bincount(of[i], (counts * lean)[i], len(g))) / h
            np.clip(y, 0, 1, out=y)
        pull = np.zeros(len(counts))
        for of, i, y in zip(member, inside, price):
            pull[i] += y[of[i]]
        new = onto(p + pull / max(1, len(goals)))
        lean, p = 2 * new - p, new
        if step >= rounds // 2:  # the mean of the later points settles where single ones still swing
            mean += p
            seen += 1
    return onto(mean / max(1, seen))


def proportional_sample(df: DataFrame, targets: DataFrame, levels: Sequence[str] = ("domain", "task", "stratum"), id_col: str = "id", seed: str = "p1") -> tuple[DataFrame, DataFrame]:
    """(sample, report). Method: systematic unequal-probability sampling. Inclusion probabilities per cell of labels
    (least_shortfall, with the size as a hard condition); rows in random (hash) order within sorted cells; integer prefix sums across partitions; a row is taken where
    the sum crosses an integer after one random start; then floors are repaired with the next rows in random order.

    targets: target_level, category, target_share, sample_fraction, min_rows. Labels are equal when they differ only in
    case, blanks, hyphens and underscores. Ids count once (repeated deliveries; the smallest label wins), null ids are
    dropped, null labels belong to no category and such rows are drawn at the rate of their other labels. Empty input
    gives an empty sample and a report with 0 available. Only the id and the labels are read.

    sample: id and the levels' keys, `repaired` true for rows added for a floor (so the size may exceed the target by
    those). report, a row per category of targets: available, needed (the larger of min_rows and share x size),
    selected, share, met (selected >= needed within one row and the floor), attainable (available >= needed), short_by
    (rows that it lacks). Targets of different levels can contradict each other: then the lack is the least possible in
    expectation, and attainable categories may be short."""
    spark = df.sparkSession
    goals = targets.select("target_level", "category", "target_share", "sample_fraction", "min_rows", label_key(F.col("category")).alias("key")).filter(F.col("target_level").isin(*levels)).collect()
    known = {lv: sorted({g.key for g in goals if g.target_level == lv and g.key}) for lv in levels}
    wanted = [F.when(label_key(F.col(lv)).isin(known[lv]), label_key(F.col(lv))).alias(f"_{i}") if known[lv] else F.lit(None).cast("string").alias(f"_{i}") for i, lv in enumerate(levels)]
    keys = [f"_{i}" for i in range(len(levels))]
    # one row per id; the pre-aggregation shuffles ids and short labels only
    rows = cut(df.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.min(F.struct(*levels)).alias("_l"))
               .select("_id", *[F.col("_l")[lv].alias(lv) for lv in levels]).select("_id", *wanted, hash_unit(F.lit(seed), F.col("_id")).alias("_h")), "p1rows")

    cells = rows.groupBy(*keys).count().limit(MAX_CELLS + 1).collect()
    if len(cells) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} combinations of target labels")
    cells.sort(key=lambda c: tuple("" if c[k] is None else c[k] for k in keys))
    counts = np.array([c["count"] for c in cells], float)
    total = int(counts.sum())
    fraction = max((g.sample_fraction for g in goals if g.sample_fraction is not None), default=0.0)
    size = fraction * total
    need, level_goals, member = {}, [], []
    for i, lv in enumerate(levels):
        at = {k: n for n, k in enumerate(known[lv])}
        goal = np.zeros(len(at))
        have = np.zeros(len(at))
        for c in cells:
            if c[keys[i]] is not None:
                have[at[c[keys[i]]]] += c["count"]
        for g in goals:
            if g.target_level == lv and g.key:
                need[lv, g.key] = max(g.min_rows or 0, (g.target_share or 0) * (g.sample_fraction or 0) * total)
                goal[at[g.key]] = min(need[lv, g.key], have[at[g.key]])
        level_goals.append(goal)
        member.append(np.array([at[c[keys[i]]] if c[keys[i]] is not None else -1 for c in cells], int))
    p = least_shortfall(counts, member, level_goals, size) if len(cells) and size else np.zeros(len(cells))
    rate = np.minimum(UNIT, np.round(p * UNIT)).astype("int64")
    before = np.concatenate([[0], np.cumsum(rate * counts.astype("int64"))])[:-1] if len(cells) else np.zeros(0, "int64")
    chunks = np.maximum(1, np.ceil(counts / CHUNK)).astype("int64")
    plan = spark.createDataFrame(
        [(*[c[k] for k in keys], n, int(rate[n]), int(before[n]), int(chunks[n])) for n, c in enumerate(cells)],
        ", ".join(f"{k}_ string" for k in keys) + ", cell int, rate long, before long, chunks long",
    )
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys])
    drawn = rows.join(small(plan), same).withColumn("chunk", (F.col("_h") * F.col("chunks") / F.lit(2.0**52)).cast("long"))
    # prefix sums: totals of all chunks before, then the rank inside the chunk
    per_chunk = drawn.groupBy("cell", "chunk").agg(F.count("*").alias("n"))
    starts = per_chunk.select("cell", "chunk", (F.sum("n").over(Window.partitionBy("cell").orderBy("chunk")) - F.col("n")).alias("rows_before"))
    rank = F.row_number().over(Window.partitionBy("cell", "chunk").orderBy("_h", "_id"))
    start = int.from_bytes(seed.encode(), "big") * 2654435761 % UNIT
    hit = F.expr(f"(before + rate * (rows_before + rank) + {start}L) div {UNIT}L > (before + rate * (rows_before + rank - 1) + {start}L) div {UNIT}L")
    ranked = drawn.withColumn("rank", rank).join(starts, ["cell", "chunk"])
    taken = cut(ranked.select("_id", "_h", *keys, hit.alias("hit")), "p1drawn")

    def per_category(frame: DataFrame) -> dict[tuple[str, str], int]:
        got = {}
        pairs = F.explode(F.array(*[F.struct(F.lit(lv).alias("lv"), F.col(keys[i]).alias("k")) for i, lv in enumerate(levels)]))
        for r in frame.select(*keys).groupBy(*keys).count().select(pairs.alias("x"), "count").groupBy("x").agg(F.sum("count").alias("n")).collect():
            if r.x.k is not None:
                got[r.x.lv, r.x.k] = r.n
        return got

    have, got = per_category(rows), per_category(taken.filter("hit"))
    floors = {(g.target_level, g.key): g.min_rows or 0 for g in goals if g.key}
    short = [(lv, k, min(f, have.get((lv, k), 0)) - got.get((lv, k), 0)) for (lv, k), f in floors.items() if min(f, have.get((lv, k), 0)) > got.get((lv, k), 0)]
    sample = taken.filter("hit").select("_id", *keys, F.lit(False).alias("repaired"))
    if short:
        lacking = spark.createDataFrame(short, "lv string, k string, lack long")
        tagged = taken.filter("not hit").select("*", F.explode(F.array(*[F.struct(F.lit(lv).alias("lv"), F.col(keys[i]).alias("k")) for i, lv in enumerate(levels)])).alias("x"))
        most = max(x[2] for x in short)
        added = (
            tagged.join(F.broadcast(lacking), (F.col("x.lv") == F.col("lv")) & (F.col("x.k") == F.col("k")))  # at most one row per target category
            .withColumn("r", F.row_number().over(Window.partitionBy("lv", "k").orderBy("_h", "_id"))).filter((F.col("r") <= most) & (F.col("r") <= F.col("lack")))
            .select("_id", *keys).distinct().withColumn("repaired", F.lit(True))
        )
        sample = cut(sample.unionByName(added), "p1sample")
        got = per_category(sample)
    sample = sample.select(F.col("_id").alias("id"), *[F.col(keys[i]).alias(lv) for i, lv in enumerate(levels)], "repaired")
    n = sum(v for (lv, _), v in got.items() if lv == levels[0]) or 1
    report = [
        (g.target_level, g.category, have.get((g.target_level, g.key), 0), float(need.get((g.target_level, g.key), 0.0)), got.get((g.target_level, g.key), 0), got.get((g.target_level, g.key), 0) / n,
         got.get((g.target_level, g.key), 0) >= need.get((g.target_level, g.key), 0.0) - 1 and got.get((g.target_level, g.key), 0) >= (g.min_rows or 0), have.get((g.target_level, g.key), 0) >= need.get((g.target_level, g.key), 0.0),
         float(max(0.0, need.get((g.target_level, g.key), 0.0) - got.get((g.target_level, g.key), 0))))
        for g in goals
    ]
    return sample, spark.createDataFrame(report, "target_level string, category string, available long, needed double, selected long, share double, met boolean, attainable boolean, short_by double")


def consistent_sample(df: DataFrame, weights: DataFrame, constant: float, category: str = "split", id_col: str = "id", revision: str = "data_revision", state: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(sample, state). Method: consistent weighted Poisson sampling. A record is selected when the hash of its id is
    below weight x constant. Of a category's weights the running maximum over revisions is used, and of the weights of
    an id's deliveries the largest; so an inclusion probability never falls, and no selected record is dropped by new
    records, late or repeated rows, lower weights later on, reruns or another partitioning. Nothing in the decision
    depends on how many records there are.

    weights: category, revision, weight: in force from that revision of the data on, once any record has it (a few rows
    per category). state: category, weight as returned by an earlier call; it enters the running maximum. An id that is
    delivered repeatedly counts once; null ids are dropped; a null revision counts as 0; categories are compared without
    case and surrounding blanks, and records of a category without weight are not selected. An empty table gives an empty
    sample. sample: id, revision (first), probability, since (the revision from which on it is selected)."""
    rows = df.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.coalesce(F.col(revision), F.lit(0)).alias("_rev"), F.lower(F.trim(F.col(category))).alias("category"))
    latest = rows.agg(F.max("_rev").alias("r")).first().r
    steps = weights.filter(F.col("revision") <= F.lit(-1 if latest is None else latest)).select(F.lower(F.trim("category")).alias("category"), "revision", F.col("weight").alias("w"))
    if state is not None:
        steps = steps.unionByName(state.select("category", F.lit(0).alias("revision"), F.col("weight").alias("w")))
    grow = Window.partitionBy("category").orderBy("revision")
    per = steps.withColumn("weight", F.max("w").over(grow)).groupBy("category").agg(F.max("weight").alias("weight"), F.sort_array(F.collect_list(F.struct("revision", "weight"))).alias("history"))
    per = cut(per, "p2weights")
    below = lambda w: F.col("h") < F.least(F.lit(1.0), w * F.lit(float(constant))) * F.lit(2.0**52)
    at = F.array_min(F.transform(F.filter("history", lambda x: below(x.weight)), lambda x: F.greatest(x.revision, F.col("_rev"))))
    hit = rows.withColumn("h", hash_unit(F.col("id"))).join(small(per), "category").filter(below(F.col("weight")))
    sample = hit.groupBy("id").agg(F.min("_rev").alias("revision"), F.least(F.lit(1.0), F.max("weight") * F.lit(float(constant))).alias("probability"), F.min(at).alias("since"))
    return sample, per.select("category", "weight")
