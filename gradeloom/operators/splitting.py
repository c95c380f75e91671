"""Split construction from adapted rows: quotas per task, held-out sources first, no leaks."""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.operators.overlap import near_pairs
from gradeloom.operators.selection import seeded_rank
from gradeloom.session import cut


#: Candidates of a task beyond its quota, and beyond which no row of a stratum can become one.
FACTOR, EXTRA = 3, 128
#: Fixed value: most rows of main_test.
MOST_TEST = 4_000


def candidates(rows: DataFrame, quotas: DataFrame, seed: int) -> DataFrame:
    """Per task, the first FACTOR x quota + EXTRA rows in balanced order: round-robin over its strata, within one by seeded
    rank; `place` counts in that order. The largest number over all tasks bounds what a stratum, and then a task, hands on."""
    most = FACTOR * (quotas.agg(F.max("quota")).first()[0] or 0) + EXTRA
    pool = F.lit(FACTOR) * F.col("quota") + EXTRA
    within = Window.partitionBy("task", "stratum").orderBy("rk", "id")
    ranked = rows.withColumn("rk", seeded_rank(seed, F.col("id"))).withColumn("rn", F.row_number().over(within)).filter(F.col("rn") <= most)
    few = ranked.join(F.broadcast(quotas), "task").filter(F.col("rn") <= pool)  # quotas: one row per task
    placed = few.withColumn("place", F.row_number().over(Window.partitionBy("task").orderBy("rn", "stratum"))).filter(F.col("place") <= most)
    return placed.filter(F.col("place") <= pool).drop("rn")


def admitted(cand: DataFrame, *drops: str) -> tuple[DataFrame, DataFrame]:
    """(rows, drops): per task the first `quota` candidates in their order that no drop (a boolean column, the first that holds
    counts) keeps out, re-ordered in balanced order with `pick`; and how many candidates each drop kept out before the quota
    was full."""
    reason = F.coalesce(*[F.when(F.col(d), F.lit(d)) for d in drops]) if drops else F.lit(None).cast("string")
    before = Window.partitionBy("task").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    marked = cand.withColumn("reason", reason).withColumn("_passed", F.coalesce(F.sum(F.col("reason").isNull().cast("int")).over(before), F.lit(0))).filter(F.col("_passed") < F.col("quota"))
    marked = cut(marked, "split-marked")
    kept = marked.filter("reason is null")
    kept = kept.withColumn("_rn", F.row_number().over(Window.partitionBy("task", "stratum").orderBy("rk", "id"))).withColumn("pick", F.row_number().over(Window.partitionBy("task").orderBy("_rn", "stratum")))
    return kept.drop("_rn", "_passed", "reason", "rk", "quota", "place", *drops), marked.filter("reason is not null").groupBy("task", "reason").agg(F.count("*").alias("n"))


def _sharing(rows: DataFrame, held: DataFrame) -> DataFrame:
    """Ids of rows that share a family key with a held row."""
    used = held.select(F.explode("family_keys").alias("k")).distinct()
    return rows.select("id", F.explode("family_keys").alias("k")).join(used, "k", "left_semi").select("id").distinct()


def _near(rows: DataFrame, held: DataFrame) -> DataFrame:
    """Ids of rows whose text is near one of a held row; copies of a text share its fate."""
    near = near_pairs(rows, held, "id", "text").select("a").distinct()
    texts = near.join(rows.select(F.col("id").alias("a"), F.sha2("text", 256).alias("t")), "a").select("t").distinct()
    return rows.select("id", F.sha2("text", 256).alias("t")).join(texts, "t", "left_semi").select("id")


def _marked(cand: DataFrame, name: str, *hits: DataFrame) -> DataFrame:
    ids = reduce(DataFrame.union, [h.select("id") for h in hits]).distinct().withColumn(name, F.lit(True))
    return cand.join(ids, "id", "left").withColumn(name, F.coalesce(name, F.lit(False)))


def build_splits(rows: DataFrame, specs: DataFrame, seed: int = 42, fits: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(picks, drops). picks: `split`, `task`, `id`, `pick`; drops: `split`, `task`, `reason`, `n`, candidates that were passed over
    before a quota was full. Order: main_test; then all rows of all tasks with a test quota are reserved; then rl_val; then
    rl_train. A task's rows count once per family, the first id. main_test picks are not held against anything.

    A validation candidate is dropped if it shares a family key with, or its text is near, any reserved row or a row picked for
    an earlier validation task (tasks in order of name); a training candidate if any reserved or validation row is such, or if
    a row of its family is picked for an earlier training task. fits: a condition on candidates (their
    context window, say); others are dropped. rows: id, family_id, family_keys, text, stratum, task. specs: task, train_quota,
    val_quota, test_quota. Empty tables give no rows. More than MOST_TEST test rows are an error."""
    one = Window.partitionBy("task", "family_id").orderBy("id")
    base = cut(rows.withColumn("stratum", F.coalesce("stratum", F.lit(""))).withColumn("_f", F.row_number().over(one)).filter("_f = 1").drop("_f"), "split-base")
    quota = lambda c: cut(specs.groupBy("task").agg(F.max(c).cast("int").alias("quota")).filter("quota > 0"), "split-quota")
    if (specs.agg(F.sum("test_quota")).first()[0] or 0) > MOST_TEST:
        raise ValueError(f"main_test is to hold at most {MOST_TEST} rows")
    odd = ~F.coalesce(fits, F.lit(False)) if fits is not None else F.lit(False)

    def step(split: str, c: str, held: DataFrame | None = None, conflicts=None) -> tuple[DataFrame, DataFrame]:
        cand = cut(candidates(base, quota(c), seed).withColumn("context_overflow", odd), f"split-{split}-cand")
        if held is not None:
            cand = cut(_marked(cand, "held_out_overlap", _sharing(cand, held), _near(cand, held)), f"split-{split}-held")
        names = [d for d in ("held_out_overlap", "earlier_task", "context_overflow") if d in cand.columns]
        picked, dropped = admitted(cand, *names)
        if conflicts is not None:
            # (id, earlier): earlier stands in an earlier task and, if picked, keeps id out. One task more is settled by each
            # round, and mostly all after one or two.
            against = cut(conflicts(cand.filter("not held_out_overlap")).distinct(), f"split-{split}-against")
            state = None
            while True:
                picked = cut(picked, f"split-{split}-picked")
                mark = picked.agg(F.count("*"), F.sum(F.xxhash64("id").cast("decimal(38,0)"))).first()
                if mark == state:
                    break
                state = mark
                out = against.join(picked.select(F.col("id").alias("earlier")), "earlier", "left_semi")
                picked, dropped = admitted(_marked(cand, "earlier_task", out), "held_out_overlap", "earlier_task", "context_overflow")
        return cut(picked, f"split-{split}"), dropped.select(F.lit(split).alias("split"), "task", "reason", "n")

    test, d1 = step("main_test", "test_quota")
    reserved = base.join(F.broadcast(quota("test_quota")).select("task"), "task", "left_semi")

    def in_order(pairs: DataFrame) -> DataFrame:
        """(id, earlier) of pairs a, b with tasks ta, tb."""
        first = F.col("ta") < F.col("tb")
        return pairs.filter("ta <> tb").select(F.when(first, F.col("b")).otherwise(F.col("a")).alias("id"), F.when(first, F.col("a")).otherwise(F.col("b")).alias("earlier"))

    def shared(c: DataFrame, keys: Column) -> DataFrame:
        k = c.select("id", "task", F.explode(keys).alias("k"))
        return in_order(k.select("k", F.col("id").alias("a"), F.col("task").alias("ta")).join(k.select("k", F.col("id").alias("b"), F.col("task").alias("tb")), "k"))

    def val_conflicts(c: DataFrame) -> DataFrame:
        texts = c.select("id", "task", F.sha2("text", 256).alias("t"))
        rep = texts.groupBy("t").agg(F.min("id").alias("r"))
        near = near_pairs(c, c, "id", "text").select(F.col("a").alias("r1"), F.col("b").alias("r2")).union(rep.select("r", "r"))
        side = lambda r, i, t: texts.join(rep, "t").select(F.col("r").alias(r), F.col("id").alias(i), F.col("task").alias(t))
        return shared(c, F.col("family_keys")).union(in_order(near.join(side("r1", "a", "ta"), "r1").join(side("r2", "b", "tb"), "r2")))

    val, d2 = step("rl_val", "val_quota", reserved, val_conflicts)
    held = reserved.select("id", "text", "family_keys").unionByName(val.select("id", "text", "family_keys"))
    train, d3 = step("rl_train", "train_quota", held, lambda c: shared(c, F.array("family_id")))
    part = lambda d, n: d.select(F.lit(n).alias("split"), "task", "id", "pick")
    return part(test, "main_test").unionByName(part(val, "rl_val")).unionByName(part(train, "rl_train")), d1.unionByName(d2).unionByName(d3)


def ordered_hash(lines: DataFrame, order: str, line: str) -> str:
    """SHA-256 of the JSON list of canonical lines in order, streamed to the driver partition by partition."""
    h, first = hashlib.sha256(b"["), True
    for r in lines.select(order, line).orderBy(order).toLocalIterator():
        h.update((b"" if first else b",") + r[line].encode())
        first = False
    h.update(b"]")
    return h.hexdigest()


def manifest(df: DataFrame) -> DataFrame:
    """Rows, families, tasks and domains per split."""
    return df.groupBy("split").agg(F.count("*").alias("rows"), F.countDistinct("id").alias("ids"), F.countDistinct("family_id").alias("families"), F.countDistinct("task").alias("tasks"))
