"""The benchmark protocol: planned prompts and their records to prompt, task, domain, stratum and length scores and one aggregate."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeloom.operators.metrics import pass_at_k
from gradeloom.operators.screening import DOMAINS

#: Weights of tasks within their domain; 1 for all others.
TASK_WEIGHTS = {"gsm8k": 0.5, "math500": 0.5, "arc": 0.25, "mmlu_pro": 0.25, "triviaqa": 0.5, "ifeval": 0.5, "ifbench": 0.5, "multi_if": 0.5, "multichallenge": 0.5}
#: Weights in the domain of long contexts, by the part of the task's name after the second underscore.
LONG_DOMAIN, LONG_WEIGHTS, LONG_REST = "long_context", {"rag": 0.3, "icl": 0.3}, 0.04
#: Weights of the groups of the quality benchmark, its task, and what puts its strata (capability/task) in a group.
QUALITY_DOMAIN, QUALITY_TASK = "quality", "biggen"
QUALITY_WEIGHTS = {"writing": 0.3, "chat": 0.3, "planning": 0.3, "roleplay": 0.1}
ROLEPLAY_TASK, PLANNING, REPLANNING, REFINEMENT = "role_playing", "planning", "replanning", "refinement"
WRITING_TASKS = ("writing_a_speech", "education_content_creation", "instruction_data_creation")


def _choose(c: Column, table: dict[str, float], rest: float) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), c), F.lit(rest)) if table else F.lit(rest)


def long_weight(task: Column) -> Column:
    parts = F.split(task, "_", 3)
    return _choose(F.element_at(parts, -1), LONG_WEIGHTS, LONG_REST)


def task_weight(domain: Column, task: Column, weights: dict[str, float] = TASK_WEIGHTS) -> Column:
    return F.when(domain == LONG_DOMAIN, long_weight(task)).otherwise(_choose(task, weights, 1.0))


def planned_prompts(splits: DataFrame) -> DataFrame:
    """A row per planned prompt, the first delivery of its id: id, task, domain, stratum ('default' if null), binary (true if
    null), length_bucket, reference_tokens. Null ids are left out."""
    first = F.min(F.struct("loaded_at", "task", F.lower(F.trim("domain")).alias("domain"), F.coalesce("stratum", F.lit("default")).alias("stratum"), F.coalesce("binary", F.lit(True)).alias("binary"), "length_bucket")).alias("x")
    return splits.filter("id is not null").groupBy("id").agg(first).select("id", "x.task", "x.domain", "x.stratum", "x.binary", "x.length_bucket")


def prompt_scores(planned: DataFrame, rec: DataFrame, n: int) -> DataFrame:
    """Planned prompts with the numbers of their records (samples 0 to n-1): saved, valid, capped, and for complete prompts
    (exactly n valid samples) the mean score, capped samples counting 0, and, if binary, the samples that passed. An
    incomplete prompt has no score: an error is never a 0."""
    counts_0 = F.when(F.col("capped"), 0.0).otherwise(F.col("score"))
    got = rec.filter((F.col("sample") >= 0) & (F.col("sample") < n)).groupBy("id").agg(
        F.count("*").alias("saved"), F.count_if("valid").alias("valid"), F.count_if("capped").alias("capped"), F.count_if(F.col("valid") & F.col("capped")).alias("_cut"),
        F.avg(F.when(F.col("valid"), counts_0)).alias("_mean"), F.count_if(F.col("valid") & F.col("passed") & ~F.col("capped")).alias("_passes"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    whole = F.coalesce(F.col("valid") == n, F.lit(False))
    return planned.join(got, "id", "left").select(*planned.columns, zero("saved"), zero("valid"), zero("capped"), F.when(whole, F.col("_mean")).alias("score"), F.when(whole, F.col("_cut")).alias("cut"), F.when(whole & F.col("binary"), F.col("_passes")).alias("passes"))


def _ks(ks: Sequence[int]) -> list[int]:
    return sorted({1, *ks})  # pass@1 always


def task_scores(prompts: DataFrame, n: int, ks: Sequence[int] = (1,)) -> DataFrame:
    """Per task: planned and scored prompts, mean score and its standard error (null for one prompt), capped samples, pass@k
    (null without binary prompts)."""
    passes = [F.avg(pass_at_k(F.lit(n), F.col("passes"), k)).alias(f"pass_at_{k}") for k in _ks(ks)]
    return prompts.groupBy("domain", "task").agg(
        F.count("*").alias("planned"), F.count("score").alias("prompts"), F.avg("score").alias("score"), (F.stddev_samp("score") / F.sqrt(F.count("score").cast("double"))).alias("stderr"), F.coalesce(F.sum("cut"), F.lit(0)).alias("truncated"), *passes,
    )


def stratum_scores(prompts: DataFrame) -> DataFrame:
    """Per task and stratum: scored prompts and their mean."""
    return prompts.filter("score is not null").groupBy("task", "stratum").agg(F.count("*").alias("prompts"), F.avg("score").alias("score"))


def quality_group(stratum: Column) -> Column:
    capability, task = F.substring_index(stratum, "/", 1), F.get(F.split(stratum, "/", 2), F.lit(1))
    return F.when(task == ROLEPLAY_TASK, "roleplay").when((capability == PLANNING) | (task == REPLANNING), "planning").when((capability == REFINEMENT) | task.isin(*WRITING_TASKS), "writing").otherwise("chat")


def quality_groups(strata: DataFrame, task: str = QUALITY_TASK) -> DataFrame:
    """Groups of the quality benchmark's strata: strata, their unweighted mean, and the group's weight."""
    g = strata.filter(F.col("task") == task).groupBy(quality_group(F.col("stratum")).alias("group")).agg(F.count("*").alias("strata"), F.avg("score").alias("score"))
    return g.withColumn("weight", _choose(F.col("group"), QUALITY_WEIGHTS, 0.0))


def domain_scores(tasks: DataFrame, groups: DataFrame | None = None, ks: Sequence[int] = (1,), weights: dict[str, float] = TASK_WEIGHTS) -> DataFrame:
    """Per domain: weighted mean over its scored tasks, weights renormalised over them; complete if every planned prompt of every
    task is scored; pass@k null if a scored task has none. The score of quality is that of its groups, if none is empty."""
    scored = F.col("prompts") > 0
    w = F.when(scored, task_weight(F.col("domain"), F.col("task"), weights))
    total = F.nullif(F.sum(w), F.lit(0.0))
    passes = [F.when(F.every(F.col(f"pass_at_{k}").isNotNull() | ~scored), F.sum(w * F.col(f"pass_at_{k}")) / total).alias(f"pass_at_{k}") for k in _ks(ks)]
    out = tasks.groupBy("domain").agg(
        F.count("*").alias("tasks"), F.count_if(scored).alias("scored_tasks"), F.sum("planned").alias("planned"), F.sum("prompts").alias("prompts"), (F.sum(w * F.col("score")) / total).alias("score"), F.every(F.col("prompts") == F.col("planned")).alias("complete"), *passes,
    )
    if groups is None:
        return out
    whole = groups.agg(F.count("*").alias("_n"), F.sum(F.col("weight") * F.col("score")).alias("_by_group"))  # one row
    override = (F.col("domain") == QUALITY_DOMAIN) & F.col("score").isNotNull() & (F.col("_n") == len(QUALITY_WEIGHTS))
    return out.crossJoin(F.broadcast(whole)).withColumn("score", F.when(override, F.col("_by_group")).otherwise(F.col("score"))).drop("_n", "_by_group")


def length_scores(prompts: DataFrame, tasks: DataFrame, turns: DataFrame, ks: Sequence[int] = (1,)) -> DataFrame:
    """Per length bucket: its prompts, the weighted mean over its tasks if each of them is scored on exactly the prompts of the
    bucket, and the least and most prompt tokens that its turns really had. turns: id, prompt_tokens."""
    per = prompts.filter("length_bucket is not null and length_bucket <> 0").groupBy("length_bucket", "domain", "task").agg(F.count("*").alias("here"))
    both = per.join(tasks, ["domain", "task"], "left").withColumn("_w", long_weight(F.col("task")))
    fine = F.every(F.coalesce(F.col("prompts") == F.col("here"), F.lit(False)))
    mean = lambda c: F.when(fine, F.sum(F.col("_w") * F.col(c)) / F.nullif(F.sum("_w"), F.lit(0.0))).alias(c)
    scores = both.groupBy("length_bucket").agg(F.sum("here").alias("prompts"), mean("score"), *[mean(f"pass_at_{k}") for k in _ks(ks)])
    seen = turns.join(prompts.select("id", "length_bucket").filter("length_bucket is not null"), "id").groupBy("length_bucket").agg(F.min("prompt_tokens").alias("least_tokens"), F.max("prompt_tokens").alias("most_tokens"))
    return scores.join(seen, "length_bucket", "left")


def aggregate_scores(domains: DataFrame, ks: Sequence[int] = (1,), planned: Sequence[str] = tuple(DOMAINS)) -> DataFrame:
    """One row: 100 x the unweighted means of the scored domains' scores and pass@k, whether all planned domains are complete,
    and, in their order, those that are missing and those that are partial."""
    plan = domains.sparkSession.createDataFrame(list(enumerate(planned)), "place int, domain string")
    d = plan.join(domains, "domain", "left")
    named = lambda cond: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(cond, F.struct("place", "domain")))), lambda x: x.domain), ",")
    return d.agg(
        (100 * F.avg("score")).alias("score"), *[(100 * F.avg(f"pass_at_{k}")).alias(f"pass_at_{k}") for k in _ks(ks)], F.count("score").alias("domains"),
        F.every(F.coalesce("complete", F.lit(False))).alias("complete"), named(F.col("score").isNull()).alias("missing"), named(F.col("score").isNotNull() & ~F.col("complete")).alias("partial"),
    )


def run_state(prompts: DataFrame) -> DataFrame:
    """One row over all prompts: errors (saved samples that are not valid), incomplete prompts, capped samples, and whether the
    run is free of truncation and may be compared at equal budgets."""
    errors, incomplete, capped = F.sum(F.col("saved") - F.col("valid")), F.count_if(F.col("score").isNull()), F.sum("capped")
    return prompts.agg(errors.alias("errors"), incomplete.alias("incomplete"), capped.alias("truncated"), (capped == 0).alias("truncation_free"), ((errors == 0) & (incomplete == 0)).alias("comparable"))


# --- audit of a run -------------------------------------------------------------------------------------------------


def _number(c: Column) -> Column:
    """A count or duration that can be used: not null, NaN, infinite or negative."""
    x = c.cast("double")
    return F.when(x.isNotNull() & ~F.isnan(x) & (x >= 0) & (x < float("inf")), x)


def audit_counts(prompts: DataFrame, samples: DataFrame, turns: DataFrame, n: int, by: Sequence[Sequence[str]] = ((), ("domain",), ("task",))) -> DataFrame:
    """Counters of a run overall, per domain and per task. Each of the three tables is aggregated once per grouping, and only
    the group rows are joined. prompts: of prompt_scores. samples: id, sample, task, domain, binary, valid, status, passed,
    capped, n_turns of the expected records. turns: task, domain, finish, empty."""
    def grouped(df: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
        cols = [F.col(k) if k in keys else F.lit(None).cast("string").alias(k) for k in ("domain", "task")]
        d = df.select(*cols, *[c for c in df.columns if c not in ("domain", "task")])
        return d.groupBy("domain", "task").agg(*aggs)

    c = F.col
    all_failed = c("binary") & c("score").isNotNull() & (c("failed") == n)
    out = []
    for keys in by:
        p = grouped(prompts, keys, F.count("*").alias("prompts"), (F.count("*") * n).alias("expected"), F.count("score").alias("complete"), F.count_if(all_failed).alias("all_failed"))
        s = grouped(
            samples, keys, F.count("*").alias("saved"), F.count_if("valid").alias("valid"), F.count_if(c("status") == "error").alias("errors"), F.count_if(~c("valid") & ~F.coalesce(c("status") == "error", F.lit(False))).alias("pending"),
            F.count_if(c("n_turns") > 0).alias("generated"), F.count_if(c("valid") & c("binary") & c("passed")).alias("passed"), F.count_if(c("valid") & c("binary") & ~c("passed")).alias("failed"), F.count_if(c("valid") & ~c("binary")).alias("continuous"), F.count_if("capped").alias("truncated"),
        )
        t = grouped(turns, keys, F.count("*").alias("turns"), F.count_if(c("finish") == "length").alias("truncated_turns"), F.count_if("empty").alias("empty_turns"))
        same = lambda a, b: a.join(b.withColumnsRenamed({"domain": "_d", "task": "_t"}), c("domain").eqNullSafe(c("_d")) & c("task").eqNullSafe(c("_t")), "left").drop("_d", "_t")
        out.append(same(same(p, s), t))
    every = reduce(DataFrame.unionByName, out).fillna(0)
    return (
        every.withColumn("missing", c("expected") - c("saved")).withColumn("incomplete", c("prompts") - c("complete"))
        .withColumn("pass_rate", c("passed") / F.nullif((c("passed") + c("failed")).cast("double"), F.lit(0.0))).withColumn("truncated_rate", c("truncated") / F.nullif(c("generated").cast("double"), F.lit(0.0)))
    )


def task_lists(counts: DataFrame) -> DataFrame:
    """A row per task of an audit with what it has: complete, failures, errors, truncation, no pass although complete."""
    c = F.col
    whole = c("complete") == c("prompts")
    return counts.filter("task is not null").select("task", whole.alias("complete"), (c("failed") > 0).alias("with_failures"), (c("errors") > 0).alias("with_errors"), (c("truncated") > 0).alias("with_truncation"), ((c("failed") > 0) & (c("passed") == 0) & whole).alias("no_pass_when_complete"))


def counted_values(df: DataFrame, keys: Sequence[str], value: str, missing: str) -> DataFrame:
    """How often each value occurs, most common first, ties by value: keys, value, n, place."""
    from pyspark.sql import Window

    n = df.groupBy(*keys, F.coalesce(F.col(value).cast("string"), F.lit(missing)).alias(value)).agg(F.count("*").alias("n"))
    return n.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), value)))


def turn_numbers(turns: DataFrame) -> DataFrame:
    """Numbers of each turn in long form, for distributions: domain, task, number, value (null where it is missing or unusable).
    turns: domain, task, prompt_tokens, completion_tokens, reasoning_tokens, latency, grading_seconds, output_cap."""
    names = ("prompt_tokens", "completion_tokens", "reasoning_tokens", "latency", "grading_seconds")
    used = _number(F.col("completion_tokens")) / F.nullif(_number(F.col("output_cap")), F.lit(0.0))
    each = F.array(*[F.struct(F.lit(n).alias("number"), _number(F.col(n)).alias("value")) for n in names], F.struct(F.lit("cap_used").alias("number"), used.alias("value")))
    return turns.select("domain", "task", F.explode(each).alias("x")).select("domain", "task", "x.*")


def judge_stats(attempts: DataFrame) -> DataFrame:
    """One row over judge attempts (status, attempt, finish, fenced, completion_tokens, latency): attempts, failed, retries,
    fenced, cut off, tokens and seconds; missing numbers count 0 here."""
    zero = lambda c: F.coalesce(F.sum(_number(F.col(c))), F.lit(0.0))
    return attempts.agg(
        F.count("*").alias("attempts"), F.count_if(F.coalesce(F.col("status") != "valid", F.lit(True))).alias("failed"), F.count_if(F.col("attempt") > 0).alias("retries"), F.count_if("fenced").alias("fenced"),
        F.count_if(F.col("finish") == "length").alias("cut_off"), zero("completion_tokens").alias("completion_tokens"), zero("latency").alias("seconds"),
    )


def compact_records(samples: DataFrame) -> DataFrame:
    """What an audit keeps of a record, without prompts, responses, gold and raw bodies: id, sample, task, domain, the grade's status,
    score, passed, error, and of each turn finish, tokens, latency, grading time, cap, and whether its text is empty."""
    turn = lambda t: F.struct(
        t.response.finish_reason.alias("finish"), t.response.usage.prompt_tokens.alias("prompt_tokens"), t.response.usage.completion_tokens.alias("completion_tokens"), t.response.usage.reasoning_tokens.alias("reasoning_tokens"),
        t.response.latency.alias("latency"), t.grading_seconds.alias("grading_seconds"), F.coalesce(t.response.text, F.lit("")).rlike(r"(?U)^\s*$").alias("empty"), t.response.request.max_tokens.alias("output_cap"))
    return samples.select("id", "sample", "task", F.lower(F.trim("domain")).alias("domain"), "grade.status", "grade.score", "grade.passed", "grade.error", F.transform("turns", turn).alias("turns"))


def integrity_issues(samples: DataFrame, planned: DataFrame, n: int, file: str | None = None) -> DataFrame:
    """`id`, `sample`, `issue`: the first problem of each stored record that does not belong to a run as it stands: an id that was not
    planned, a sample outside of 0 to n-1, one stored more than once (each of them), a file of another name, another task or
    domain than the row's, a grade of an unknown status, a valid one whose score is no number from 0 to 1, and one of a binary row
    without a verdict. samples: id, sample, task, domain, status, score, passed (and a column of file names)."""
    from pyspark.sql import Window

    c = F.col
    plan = planned.select(c("id").alias("_id"), c("task").alias("_task"), c("domain").alias("_domain"), c("binary").alias("_binary"))
    d = samples.withColumn("_n", F.count("*").over(Window.partitionBy("id", "sample"))).join(plan, c("id") == c("_id"), "left")
    named = F.lit(False) if file is None else ~F.element_at(F.split(c(file), "/"), -1).eqNullSafe(F.concat(c("id"), F.lit("."), c("sample").cast("string"), F.lit(".json")))
    valid = c("status").eqNullSafe("valid")
    number = c("score").isNotNull() & ~F.isnan("score") & c("score").between(0, 1)
    issue = (
        F.when(c("_id").isNull(), "unexpected id").when(~F.coalesce(c("sample").between(0, n - 1), F.lit(False)), "sample index").when(c("_n") > 1, "stored more than once").when(named, "file name")
        .when(~c("task").eqNullSafe(c("_task")), "task").when(~c("domain").eqNullSafe(c("_domain")), "domain").when(c("status").isNotNull() & ~c("status").isin("valid", "error"), "grade status")
        .when(valid & ~F.coalesce(number, F.lit(False)), "score").when(valid & c("_binary") & c("passed").isNull(), "no verdict")
    )
    return d.select("id", "sample", issue.alias("issue")).filter("issue is not null")


def policy_violations(rec: DataFrame, planned_turns: DataFrame) -> DataFrame:
    """`id`, `sample`, `issue` of valid records: fewer turns than planned although the last one was not cut off, or none at all; and
    cut off, yet scored. rec: id, sample, valid, score, passed, capped, n_turns, last_finish. planned_turns: id, expected."""
    c = F.col
    d = rec.filter("valid").join(planned_turns, "id", "left").withColumn("expected", F.coalesce("expected", F.lit(1)))
    ended = c("last_finish").eqNullSafe("length") & (c("n_turns") < c("expected"))
    issues = F.array(F.when((c("n_turns") == 0) | ((c("n_turns") != c("expected")) & ~ended), "incomplete trajectory"), F.when(c("capped") & ((c("score") != 0) | F.coalesce("passed", F.lit(False))), "capped but scored"))
    return d.select("id", "sample", F.explode(F.array_compact(issues)).alias("issue"))


def metric_differences(saved: dict, recomputed: dict, names: Sequence[str] = ("truncated", "errors", "incomplete", "score", "complete")) -> list[tuple[str, object, object]]:
    """(metric, saved, recomputed) where a saved report of a run that has ended differs; metrics that an older report lacks are
    left out."""
    return [(n, saved[n], recomputed.get(n)) for n in names if n in saved and saved[n] != recomputed.get(n)]
