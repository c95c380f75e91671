"""Deterministic selection: first in order, seeded ranks, balanced and round-robin picks, prefixes within a budget."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.session import cut, small


def seeded_rank(seed: int, ident: Column) -> Column:
    """SHA-256 of the canonical JSON list [seed, ident]; ids must need no escapes."""
    return F.sha2(F.concat(F.lit(f'[{seed},"'), ident.cast("string"), F.lit('"]')), 256)


def sampling_seed(seed: int, ident: Column, sample: Column, turn: Column) -> Column:
    """(seed + first 32 bits of the hex id + 1009 sample + 97 turn) modulo 2^31."""
    return F.pmod(F.lit(seed).cast("long") + F.conv(F.substring(ident, 1, 8), 16, 10).cast("long") + sample * 1009 + turn * 97, F.lit(2147483648))


def held_out(ident: Column) -> Column:
    """Whether an id belongs to the held-out fifth, by its hash."""
    return F.conv(F.substring(F.sha2(F.concat(F.lit('"'), ident.cast("string"), F.lit('"')), 256), 1, 8), 16, 10).cast("long") % 5 == 0


def first_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row per key in the given order."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter("_rn = 1").drop("_rn")


def top_per_stratum(df: DataFrame, stratum: str, rank: Column, order: str, n: int) -> DataFrame:
    """The n smallest ranks per stratum (planned as a bounded group limit before the shuffle)."""
    return df.withColumn("rk", rank).withColumn("rn", F.row_number().over(Window.partitionBy(stratum).orderBy("rk", order))).filter(F.col("rn") <= n)


def balanced(df: DataFrame, stratum: str, rank: Column, order: str, n: int) -> DataFrame:
    """Round-robin over the sorted strata, within a stratum by rank, until n rows; `pick` is the place in that order.
    Only the first n per stratum can be picked, so no more than those are sorted."""
    top = top_per_stratum(df, stratum, rank, order, n).orderBy("rn", stratum).limit(n)
    return top.withColumn("pick", F.row_number().over(Window.orderBy("rn", stratum)))


def _chunked(df: DataFrame, group: str, order: list[str], size: Column | None) -> DataFrame:
    """df with `_rank` (from 1) and `_sum` (running size) per group in order, a hot group being no task of its own: rows are sorted
    once over all groups by range, sums of the parts before are added to the sums within a part."""
    ranged = df.withColumn("_s", F.coalesce(size, F.lit(0)) if size is not None else F.lit(0)).repartitionByRange(F.col(group).asc_nulls_first(), *order).sortWithinPartitions(F.col(group).asc_nulls_first(), *order)
    ranged = cut(ranged.withColumn("_part", F.spark_partition_id()), "chunks")
    parts = ranged.groupBy(group, "_part").agg(F.count("*").alias("_n"), F.sum("_s").alias("_t"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col(group).alias("_g"), F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"), F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_t0"))
    inside = Window.partitionBy(group, "_part").orderBy(*order)
    own = ranged.withColumn("_r", F.row_number().over(inside)).withColumn("_u", F.sum("_s").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    both = own.join(small(parts), F.col(group).eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")))
    return both.withColumn("_rank", (F.col("_r") + F.col("_n0")).cast("int")).withColumn("_sum", F.col("_u") + F.col("_t0")).drop("_s", "_part", "_g", "_p", "_n0", "_t0", "_r", "_u")


def prefix_budget(df: DataFrame, group: str, order: list[str], size: str, budget: int) -> DataFrame:
    """Rows of each group, in order, until the running size exceeds the budget; nothing after the first overflow. Null sizes
    count 0. The order must have no ties within a group."""
    run = _chunked(df, group, order, F.col(size)).withColumnRenamed("_sum", "used").drop("_rank")
    over = run.filter(F.col("used") > budget).groupBy(F.col(group).alias("_g")).agg(F.min(F.struct(*order)).alias("_first"))
    return run.join(small(over), F.col(group).eqNullSafe(F.col("_g")), "left").filter(F.col("_first").isNull() | (F.struct(*order) < F.col("_first"))).drop("_g", "_first")


def balance_order(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Column-major interleaving: the first of every group, then the second of every group, and so on; `turn` is the round."""
    return _chunked(df, group, order, None).withColumnRenamed("_rank", "turn").drop("_sum")


def interleave(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """`turn` (round) and `first_seen` (place of the group's first row) per row: sorted by both, groups take turns in the order
    in which they were first seen. order: columns whose order is that of the input."""
    firsts = df.groupBy(group).agg(F.min(F.struct(*order)).alias("first_seen"))
    return balance_order(df, group, order).join(small(firsts.withColumnRenamed(group, "_g")), F.col(group).eqNullSafe(F.col("_g"))).drop("_g")


def run_selection(rows: DataFrame, order: str, model_context: int, buckets: Sequence[int] = (), tasks: Sequence[str] = (), limit: int = 0, counts: dict[str, int] | None = None) -> DataFrame:
    """The prompts of a run, in steps: those whose length bucket the model's context holds and, if buckets are given, that are in
    one of them (rows without a bucket always); the tasks; the first `limit` of each task; then the first counts[task] of it."""
    bucket = F.coalesce("length_bucket", F.lit(0))
    kept = rows.filter((bucket <= model_context) & ((bucket == 0) | (bucket.isin(*buckets) if buckets else F.lit(True))))
    kept = kept.filter(F.col("task").isin(*tasks)) if tasks else kept
    table = [(t, n) for t, n in (counts or {}).items()]
    most = F.lit(limit or None).cast("int")
    if table:
        most = F.least(most, F.try_element_at(F.create_map(*[F.lit(x) for kv in table for x in kv]), F.col("task")))
    rank = F.row_number().over(Window.partitionBy("task").orderBy(order))
    if not limit and not table:
        return kept
    ranked = kept.withColumn("_rn", rank)
    bound = max([limit, *(n for _, n in table)]) if limit or len(table) else 0
    ranked = ranked.filter(F.col("_rn") <= bound) if limit else ranked  # a literal bound lets each task keep few rows before the shuffle
    return ranked.filter(most.isNull() | (F.col("_rn") <= most)).drop("_rn")


def display_order(tasks: DataFrame, domains: Sequence[str]) -> DataFrame:
    """Tasks in the order in which tables show them: by the place of their domain, then by name; `place` from 1."""
    at = F.array_position(F.array(*map(F.lit, domains)), F.col("domain"))
    return tasks.withColumn("place", F.row_number().over(Window.orderBy(F.when(at > 0, at).otherwise(len(domains) + 1), "task")))
