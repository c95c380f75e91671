"""Scores from samples to prompts, tasks, domains and one aggregate; distributions and audits of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pass_at_k(n: Column, c: Column, k: int) -> Column:
    """Unbiased pass@k, 1 - C(n-c, k) / C(n, k); 1 where fewer than k samples failed; null where c is outside of [0, n] or k of [1, n]."""
    misses = F.aggregate(F.sequence(F.lit(0), F.lit(k - 1)), F.lit(1.0), lambda a, i: a * (n - c - i) / F.nullif((n - i).cast("double"), F.lit(0.0)))
    return F.when((n >= k) & (c >= 0) & (c <= n), F.when(n - c < k, F.lit(1.0)).otherwise(1.0 - misses))


def last_write(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last stored row per key; ties are broken by the given order, so the result does not depend on partitioning."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def records(samples: DataFrame) -> DataFrame:
    """A row per (id, sample), narrow: the last stored delivery wins. valid: graded without error and with a number;
    capped: a turn stopped at the token limit; missing numbers stay null. Rows without id or sample are left out."""
    finish = "exists(turns, t -> coalesce(t.response.finish_reason = 'length', false))"
    tokens = "transform(turns, t -> t.response.usage.completion_tokens)"
    flat = samples.filter("id is not null and sample is not null").select(
        "id", "sample", "task", F.lower(F.trim("domain")).alias("domain"), "run", "stored_at", "finished_at",
        F.expr("coalesce(grade.status = 'valid' and grade.score is not null and not isnan(grade.score), false)").alias("valid"),
        F.col("grade.status").alias("status"), F.col("grade.score").alias("score"), F.col("grade.passed").alias("passed"), F.col("grade.error").alias("error"),
        F.expr(f"coalesce({finish}, false)").alias("capped"), F.expr("coalesce(size(turns), 0)").alias("n_turns"),
        F.expr(f"case when size(turns) > 0 and forall({tokens}, x -> x is not null) then aggregate({tokens}, 0L, (a, x) -> a + x) end").alias("completion_tokens"),
    )
    return last_write(flat, ["id", "sample"], [F.desc("stored_at"), F.desc("finished_at"), F.desc("run")]).drop("stored_at", "finished_at")


def prompt_rollup(rec: DataFrame, n: int) -> DataFrame:
    """Per prompt over samples 0 .. n-1: mean score, capped samples counting 0; a prompt with fewer than n valid samples
    has no score and is incomplete (an error is never a 0). passes is null unless all samples have a verdict."""
    got = rec.filter((F.col("sample") >= 0) & (F.col("sample") < n)).groupBy("id").agg(
        F.min("task").alias("task"), F.min("domain").alias("domain"), F.count_if("valid").alias("valid"), F.count_if(F.col("valid") & F.col("capped")).alias("capped"),
        F.avg(F.when(F.col("valid"), F.when(F.col("capped"), 0.0).otherwise(F.col("score")))).alias("_mean"),
        F.count_if(F.col("valid") & F.col("passed") & ~F.col("capped")).alias("_passes"), F.count_if(F.col("valid") & F.col("passed").isNotNull()).alias("_verdicts"),
    )
    whole = F.col("valid") == n
    return got.select("id", "task", "domain", "valid", "capped", F.when(whole, F.col("_mean")).alias("score"), F.when(whole & (F.col("_verdicts") == n), F.col("_passes")).alias("passes"))


def task_rollup(prompts: DataFrame, n: int, ks: tuple[int, ...] = (1, 2)) -> DataFrame:
    """Per task: prompts, complete and incomplete ones, mean and standard error of prompt scores, pass@k."""
    passes = [F.avg(pass_at_k(F.lit(n), F.col("passes"), k)).alias(f"pass_at_{k}") for k in ks]
    return prompts.groupBy("domain", "task").agg(
        F.count("*").alias("prompts"), F.count("score").alias("complete"), (F.count("*") - F.count("score")).alias("incomplete"), F.sum("capped").alias("capped"),
        F.avg("score").alias("score"), (F.stddev_samp("score") / F.sqrt(F.count("score").cast("double"))).alias("stderr"), *passes,
    )


def distribution(df: DataFrame, value: str, keys: list[str] = []) -> DataFrame:  # noqa: B006
    """Count, missing, total, extremes, mean, population deviation and linear percentiles. Null, NaN, infinite and negative values are missing, never 0."""
    x = F.col(value).cast("double")
    v = F.when(x.isNotNull() & ~F.isnan(x) & (x >= 0) & (x < float("inf")), x)
    d = df.select(*keys, v.alias("_v"))
    q = lambda p: F.percentile("_v", p)
    aggs = [F.count("_v").alias("n"), (F.count("*") - F.count("_v")).alias("missing"), F.sum("_v").alias("total"), F.min("_v").alias("least"), F.max("_v").alias("most"), F.avg("_v").alias("mean"), F.stddev_pop("_v").alias("deviation"), q(0.5).alias("p50"), q(0.9).alias("p90"), q(0.95).alias("p95"), q(0.99).alias("p99")]
    return (d.groupBy(*keys) if keys else d).agg(*aggs)


#: Lower edges of the token histogram; the last bucket is open.
EDGES = [0, 128, 256, 512, 1024, 2048, 4096, 8192, 16384, 32768, 65536, 131072]


def token_histogram(df: DataFrame, value: str) -> DataFrame:
    """Half-open buckets, all present even if empty: bucket (number), low, n."""
    low = df.sparkSession.createDataFrame(list(enumerate(EDGES)), "bucket int, low long")
    at = F.lit(-1)
    for e in EDGES:
        at = at + (F.col(value) >= e).cast("int")
    got = df.filter(F.col(value) >= 0).select(at.alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))
    return low.join(got, "bucket", "left").select("bucket", "low", F.coalesce("n", F.lit(0)).alias("n"))


def coverage_grid(ids: DataFrame, rec: DataFrame, n: int) -> DataFrame:
    """Every expected (id, sample): valid, error, pending (stored but not graded) or missing."""
    grid = ids.select("id").distinct().select("id", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("sample"))
    state = F.when(F.col("_x").isNull(), "missing").when(F.col("valid"), "valid").when(F.col("status").isNull(), "pending").otherwise("error")
    return grid.join(rec.select("id", "sample", "valid", "status", F.lit(1).alias("_x")), ["id", "sample"], "left").select("id", "sample", state.alias("state"))


def pending_work(ids: DataFrame, rec: DataFrame, n: int) -> DataFrame:
    """Expected (id, sample) without a valid record."""
    grid = ids.select("id").distinct().select("id", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("sample"))
    return grid.join(rec.filter("valid").select("id", "sample"), ["id", "sample"], "left_anti")


def summarize(rec: DataFrame) -> DataFrame:
    """Counters overall, per domain and per task in one pass: grouping sets ((), (domain), (task))."""
    c = F.col
    return rec.groupingSets([[], ["domain"], ["task"]], "domain", "task").agg(
        F.count("*").alias("saved"), F.count_if("valid").alias("valid"), F.count_if(c("status") == "error").alias("errors"), F.count_if(c("status").isNull()).alias("pending"),
        F.count_if(c("valid") & c("passed")).alias("passed"), F.count_if(c("valid") & ~c("passed")).alias("failed"), F.count_if(c("valid") & c("passed").isNull()).alias("continuous"), F.count_if("capped").alias("truncated"),
        F.sum("n_turns").alias("turns"), F.count("completion_tokens").alias("with_tokens"), F.sum("completion_tokens").alias("tokens"),
    )


def failure_reason(components: Column | None = None) -> Column:
    """First reason that holds, for a valid record that has not passed and scores 0, from what its grade's components (JSON text)
    tell; without components, cut-off turns, records without turns and missing verdicts are all that can be told."""
    earned = ~F.col("valid") | F.coalesce(F.col("passed"), F.lit(False)) | (F.col("score") > 0)
    start = F.when(earned, None).when(F.col("capped"), "truncated")
    if components is None:
        return start.when(F.col("n_turns") == 0, "metrics only").when(F.col("passed").isNull(), "quality").otherwise("wrong answer")
    at = lambda n: F.get_json_object(components, f"$.{n}")
    ran = F.when(at("syntax_error").isNotNull() & (at("syntax_error") != "false"), "syntax error").when(at("defines_entry_point") == "false", "requested function not defined").otherwise(at("execution_status"))
    return (
        start.when(F.coalesce(at("failure"), F.lit("")) != "", F.replace(at("failure"), F.lit("_"), F.lit(" "))).when(F.coalesce(at("execution_status"), F.lit("")) != "", F.concat(F.lit("code: "), ran)).when(at("syntax") == "false", "unparseable structure")
        .when(at("schema") == "false", "schema mismatch").when(at("requested_format") == "false", "answer in other format").when(at("acceptability").isNotNull(), F.when(at("mandatory_pass") == "false", "mandatory check failed").otherwise("lowest quality score")).otherwise("wrong answer")
    )


def group_validation(rec: DataFrame, n: int) -> DataFrame:
    """Per id whether its group can be used: n >= 2 records with the samples 0 .. n-1, all valid, in [0, 1], and none that failed with a score."""
    fine = F.col("valid") & F.col("score").between(0, 1) & ~(F.col("passed").isNotNull() & ~F.coalesce(F.col("passed"), F.lit(True)) & (F.col("score") > 0))
    return rec.groupBy("id").agg(F.count("*").alias("records"), (F.lit(n >= 2) & (F.count("*") == n) & (F.min("sample") == 0) & (F.max("sample") == n - 1) & F.every(F.coalesce(fine, F.lit(False)))).alias("accepted"))


def guarded_corr(x: str, y: str) -> Column:
    """Pearson correlation; null for fewer than 3 pairs or no variance. Equal values are told by their extremes, as deviations merged
    from several partitions can miss 0 by a rounding error."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = F.when(both, F.col(x).cast("double")), F.when(both, F.col(y).cast("double"))
    varied = (F.min(a) < F.max(a)) & (F.min(b) < F.max(b))
    return F.when((F.count_if(both) >= 3) & varied, F.covar_pop(a, b) / F.nullif(F.stddev_pop(a) * F.stddev_pop(b), F.lit(0.0)))


def wilson_upper(k: Column, n: Column, z: float = 1.96) -> Column:
    """Upper bound of the Wilson interval; null for n = 0."""
    m = F.nullif(n.cast("double"), F.lit(0.0))
    p = k / m
    return (p + z * z / (2 * m) + z * F.sqrt(p * (1 - p) / m + z * z / (4 * m * m))) / (1 + z * z / m)


def nearest_lower(df: DataFrame, keys: list[str], value: str, qs: list[float], names: list[str]) -> DataFrame:
    """Per group the elements at floor(q (n-1)) of the sorted values (nulls left out): distinct values are counted first, so that
    what is ranked per group is distinct values only."""
    v = df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.count("*").alias("_c"))
    w = Window.partitionBy(*keys).orderBy("_v")
    v = v.withColumn("_to", F.sum("_c").over(w)).withColumn("_n", F.sum("_c").over(Window.partitionBy(*keys)))
    at = lambda q: F.floor(F.lit(q) * (F.col("_n") - 1))
    return v.groupBy(*keys).agg(*[F.min(F.when(F.col("_to") > at(q), F.col("_v"))).alias(n) for q, n in zip(qs, names)])


def joined_text() -> Column:
    """The texts of all turns of a record, one below the other."""
    return F.array_join(F.filter(F.transform("turns", lambda t: t.response.text), lambda x: x.isNotNull()), "\n")


def repeated_grams(df: DataFrame, text: str, out: str, size: int = 4) -> DataFrame:
    """df with 1 - distinct / all runs of `size` words; 0 for fewer words."""
    words = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"(?U)[\s\x1c-\x1f]+"), lambda w: w != "")
    # the words are bound to the outer lambda's variable, so they are computed once per row and not once per run
    runs = lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - size + 1, F.lit(1))), lambda i: F.array_join(F.slice(w, i, F.lit(size)), " "))
    share = lambda w: F.when(F.size(w) < size, F.lit(0.0)).otherwise(1 - F.size(F.array_distinct(runs(w))) / (F.size(w) - size + 1))
    return df.withColumn(out, F.get(F.transform(F.array(words), share), F.lit(0)))


def _watched(rec: DataFrame, samples: DataFrame) -> DataFrame:
    """Records with the repetition of their joined text, to the 6 places that it is reported with, and their tokens, missing ones
    counting 0 here. Scaled before rounding, as SQL does it: a share just below a tie stays below."""
    tokens = F.expr("coalesce(aggregate(transform(turns, t -> coalesce(cast(t.response.usage.completion_tokens as bigint), 0)), 0L, (a, x) -> a + x), 0)")
    extra = repeated_grams(samples.select("id", "sample", joined_text().alias("_text"), tokens.alias("tokens")), "_text", "repetition").drop("_text")
    return rec.join(extra.withColumn("repetition", F.round(F.col("repetition") * 1e6) / 1e6), ["id", "sample"])


def audit_queue(rec: DataFrame, samples: DataFrame, least: float = 0.75, n: int = 100) -> DataFrame:
    """The n well-scored records that repeat themselves most, then the longest; ties by id and sample. `place` from 1."""
    order = [F.desc("repetition"), F.desc("tokens"), F.col("id"), F.col("sample")]
    top = _watched(rec.filter(F.col("valid") & (F.col("score") >= least)), samples).orderBy(*order).limit(n)
    return top.withColumn("place", F.row_number().over(Window.orderBy(*order)))


def reliability(rec: DataFrame, samples: DataFrame) -> DataFrame:
    """Per domain: samples, errors, cut-off ones, and how scores go with tokens and with repetition."""
    d = _watched(rec, samples).withColumn("_s", F.when(F.col("valid"), F.col("score")))
    return d.groupBy("domain").agg(F.count("*").alias("samples"), F.count_if(~F.col("valid")).alias("errors"), F.count_if("capped").alias("cap_hits"), guarded_corr("_s", "tokens").alias("score_length"), guarded_corr("_s", "repetition").alias("score_repetition"))


def leaderboard(rec: DataFrame, domains: list[str], by: str = "run") -> DataFrame:
    """A row per run with the mean score of each domain as a column, best first, runs without a score last."""
    wide = rec.filter("valid").groupBy(by).pivot("domain", domains).agg(F.round(F.avg("score"), 9))
    every = rec.groupBy(by).agg(F.round(F.avg(F.when(F.col("valid"), F.col("score"))), 9).alias("overall"), F.count("*").alias("saved"))
    return every.join(wide, by, "left").withColumn("place", F.row_number().over(Window.orderBy(F.desc_nulls_last("overall"), by)))
