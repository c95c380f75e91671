"""Queries by name on the project's tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.functions import extract as X
from gradeloom.functions.ids import family_keys, normalized_col
from gradeloom.functions.labels import label_key, language_code
from gradeloom.operators import grading, metrics, overlap, screening, selection, splitting
from gradeloom.plans.registry import query
from gradeloom.sources import adapters
from gradeloom.streaming import requests

#: Samples per prompt that the rollups expect.
N = 2

# --- records, rollups, audits -------------------------------------------------------------------------------------

REC = """r0 AS (SELECT id, sample, task, lower(trim(domain)) AS domain, run, coalesce(grade.status = 'valid' AND grade.score IS NOT NULL AND NOT isnan(grade.score), false) AS valid,
 grade.status AS status, grade.score AS score, grade.passed AS passed, grade.error AS error, coalesce(len(list_filter(turns, lambda t: t.response.finish_reason = 'length')) > 0, false) AS capped,
 coalesce(len(turns), 0) AS n_turns, CASE WHEN len(turns) > 0 AND len(list_filter(turns, lambda t: t.response.usage.completion_tokens IS NULL)) = 0
 THEN list_sum(list_transform(turns, lambda t: t.response.usage.completion_tokens)) END AS completion_tokens,
 row_number() OVER (PARTITION BY id, sample ORDER BY stored_at DESC, finished_at DESC, run DESC) AS rn FROM samples WHERE id IS NOT NULL AND sample IS NOT NULL),
rec AS (SELECT * EXCLUDE (rn) FROM r0 WHERE rn = 1)"""
PROMPT = f"""{REC}, p0 AS (SELECT id, min(task) AS task, min(domain) AS domain, count(*) FILTER (valid) AS valid, count(*) FILTER (valid AND capped) AS capped,
 avg(CASE WHEN valid THEN CASE WHEN capped THEN 0.0::DOUBLE ELSE score END END) AS m, count(*) FILTER (valid AND passed AND NOT capped) AS ok, count(*) FILTER (valid AND passed IS NOT NULL) AS v
 FROM rec WHERE sample >= 0 AND sample < {N} GROUP BY id),
prompts AS (SELECT id, task, domain, valid, capped, CASE WHEN valid = {N} THEN m END AS score, CASE WHEN valid = {N} AND v = {N} THEN ok END AS passes FROM p0)"""
TASK = f"""{PROMPT}, tasks AS (SELECT domain, task, count(*) AS prompts, count(score) AS complete, count(*) - count(score) AS incomplete, sum(capped)::BIGINT AS capped, avg(score) AS score,
 stddev_samp(score) / sqrt(nullif(count(score), 0)::DOUBLE) AS stderr, avg(passes / 2.0::DOUBLE) AS pass_at_1, avg(CASE WHEN passes IS NULL THEN NULL WHEN passes >= 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS pass_at_2 FROM prompts GROUP BY domain, task)"""


def _rec(t) -> DataFrame:
    return metrics.records(t("samples"))


def _prompts(t) -> DataFrame:
    return metrics.prompt_rollup(_rec(t), N)


def _tasks(t) -> DataFrame:
    return metrics.task_rollup(_prompts(t), N)


@query(f"WITH {REC} SELECT * FROM rec")
def q_records(t):
    return _rec(t)


@query(f"WITH {PROMPT} SELECT id, task, domain, valid, capped, round(score, 6) AS score, passes FROM prompts")
def q_prompt_rollup(t):
    return _prompts(t)


@query(f"WITH {TASK} SELECT * REPLACE (round(score, 6) AS score, round(stderr, 6) AS stderr, round(pass_at_1, 6) AS pass_at_1, round(pass_at_2, 6) AS pass_at_2) FROM tasks")
def q_task_rollup(t):
    return _tasks(t)


@query(f"""WITH {REC}, g AS (SELECT id, count(*) AS n, count(*) FILTER (passed AND NOT capped) AS c FROM rec WHERE valid AND passed IS NOT NULL GROUP BY id)
SELECT id, n, c, round(c / n::DOUBLE, 6) AS pass_at_1, CASE WHEN n >= 2 THEN CASE WHEN n - c < 2 THEN 1.0::DOUBLE ELSE round(1 - ((n - c) / n::DOUBLE) * ((n - c - 1) / (n - 1)::DOUBLE), 6) END END AS pass_at_2 FROM g""")
def q_pass_at_k(t):
    g = _rec(t).filter("valid and passed is not null").groupBy("id").agg(F.count("*").alias("n"), F.count_if(F.col("passed") & ~F.col("capped")).alias("c"))
    return g.select("id", "n", "c", metrics.pass_at_k(F.col("n"), F.col("c"), 1).alias("pass_at_1"), metrics.pass_at_k(F.col("n"), F.col("c"), 2).alias("pass_at_2"))


@query("""SELECT user_id, event_type, event_id, ts, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def q_last_write_dedup(t):
    return metrics.last_write(t("events"), ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_type", "event_id", "ts", "value")


_DIST = """count(v) AS n, count(*) - count(v) AS missing, round(sum(v), 6) AS total, min(v) AS least, max(v) AS most, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS deviation,
 round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.9), 6) AS p90, round(quantile_cont(v, 0.95), 6) AS p95, round(quantile_cont(v, 0.99), 6) AS p99"""


@query(f"SELECT domain, {_DIST} FROM (SELECT domain, CASE WHEN n_chars >= 0 THEN n_chars::DOUBLE END AS v FROM documents) GROUP BY domain")
def q_distribution(t):
    return metrics.distribution(t("documents"), "n_chars", ["domain"])


@query(f"WITH {REC} SELECT task, {_DIST} FROM (SELECT task, completion_tokens::DOUBLE AS v FROM rec) GROUP BY task")
def q_token_distribution(t):
    return metrics.distribution(_rec(t), "completion_tokens", ["task"])


_EDGES = ", ".join(f"({i}, {e})" for i, e in enumerate(metrics.EDGES))


@query(f"""WITH {REC}, e(bucket, low) AS (VALUES {_EDGES}), x AS (SELECT *, lead(low) OVER (ORDER BY bucket) AS high FROM e)
SELECT bucket::INT AS bucket, low::BIGINT AS low, count(completion_tokens) AS n FROM x LEFT JOIN rec ON completion_tokens >= low AND (high IS NULL OR completion_tokens < high) GROUP BY bucket, low""")
def q_token_histogram(t):
    return metrics.token_histogram(_rec(t), "completion_tokens")


@query(f"""WITH {REC}, g AS (SELECT DISTINCT id, s.sample::INT AS sample FROM splits, (SELECT unnest(range({N})) AS sample) s WHERE id IS NOT NULL)
SELECT g.id, g.sample, CASE WHEN r.id IS NULL THEN 'missing' WHEN r.valid THEN 'valid' WHEN r.status IS NULL THEN 'pending' ELSE 'error' END AS state FROM g LEFT JOIN rec r ON r.id = g.id AND r.sample = g.sample""")
def q_coverage_grid(t):
    return metrics.coverage_grid(t("splits").filter("id is not null"), _rec(t), N)


@query(f"""WITH {REC}, g AS (SELECT DISTINCT id, s.sample::INT AS sample FROM splits, (SELECT unnest(range({N})) AS sample) s WHERE id IS NOT NULL)
SELECT g.id, g.sample FROM g WHERE NOT EXISTS (SELECT 1 FROM rec r WHERE r.valid AND r.id = g.id AND r.sample = g.sample)""")
def q_pending_antijoin(t):
    return metrics.pending_work(t("splits").filter("id is not null"), _rec(t), N)


@query(f"WITH {REC} SELECT id, sample, n_turns, completion_tokens FROM rec WHERE n_turns > 0")
def q_trajectory_sum_nullprop(t):
    return _rec(t).filter("n_turns > 0").select("id", "sample", "n_turns", "completion_tokens")


@query(f"""WITH {REC} SELECT domain, task, count(*) AS saved, count(*) FILTER (valid) AS valid, count(*) FILTER (status = 'error') AS errors, count(*) FILTER (status IS NULL) AS pending, count(*) FILTER (valid AND passed) AS passed,
 count(*) FILTER (valid AND NOT passed) AS failed, count(*) FILTER (valid AND passed IS NULL) AS continuous, count(*) FILTER (capped) AS truncated, sum(n_turns)::BIGINT AS turns, count(completion_tokens) AS with_tokens, sum(completion_tokens)::BIGINT AS tokens
 FROM rec GROUP BY GROUPING SETS ((), (domain), (task))""")
def q_summarize_grouping_sets(t):
    return metrics.summarize(_rec(t))


_REASON = "CASE WHEN NOT valid OR coalesce(passed, false) OR score > 0 THEN NULL WHEN capped THEN 'truncated' WHEN n_turns = 0 THEN 'metrics only' WHEN passed IS NULL THEN 'quality' ELSE 'wrong answer' END"


@query(f"WITH {REC} SELECT id, sample, {_REASON} AS reason FROM rec")
def q_failure_reason(t):
    return _rec(t).select("id", "sample", metrics.failure_reason().alias("reason"))


@query(f"WITH {REC}, x AS (SELECT task, {_REASON} AS reason FROM rec) SELECT task, reason, count(*) AS n FROM x WHERE reason IS NOT NULL GROUP BY task, reason")
def q_failure_counts(t):
    return _rec(t).select("task", metrics.failure_reason().alias("reason")).filter("reason is not null").groupBy("task", "reason").agg(F.count("*").alias("n"))


@query("""SELECT source, count(*) AS n, CASE WHEN count(n_chars) FILTER (text IS NOT NULL) >= 3 THEN round(covar_pop(x, y) / nullif(stddev_pop(x) * stddev_pop(y), 0), 6) END AS r
 FROM (SELECT source, n_chars, text, CASE WHEN text IS NOT NULL AND n_chars IS NOT NULL THEN n_chars::DOUBLE END AS x, CASE WHEN text IS NOT NULL AND n_chars IS NOT NULL THEN length(text)::DOUBLE END AS y FROM documents) GROUP BY source""")
def q_corr_guarded(t):
    return t("documents").select("source", "n_chars", F.length("text").alias("l")).groupBy("source").agg(F.count("*").alias("n"), metrics.guarded_corr("n_chars", "l").alias("r"))


_W = "(k / n::DOUBLE + 3.8416 / (2 * n) + 1.96 * sqrt(k / n::DOUBLE * (1 - k / n::DOUBLE) / n + 3.8416 / (4 * n::DOUBLE * n))) / (1 + 3.8416 / n)"


@query(f"WITH {REC}, x AS (SELECT task, count(*) FILTER (valid AND passed) AS k, count(*) FILTER (valid AND passed IS NOT NULL) AS n FROM rec GROUP BY task) SELECT task, k, n, CASE WHEN n > 0 THEN round({_W}, 6) END AS upper FROM x")
def q_wilson_upper(t):
    g = _rec(t).groupBy("task").agg(F.count_if(F.col("valid") & F.col("passed")).alias("k"), F.count_if(F.col("valid") & F.col("passed").isNotNull()).alias("n"))
    return g.withColumn("upper", metrics.wilson_upper(F.col("k"), F.col("n")))


@query(f"""WITH {REC} SELECT domain, (('0x' || substr(sha256('"' || id || '"'), 1, 8))::BIGINT % 5 = 0) AS held_out, count(*) FILTER (NOT passed) AS negatives, count(*) FILTER (NOT passed AND score >= 0.5) AS false_accepts,
 count(*) FILTER (passed) AS positives, count(*) FILTER (passed AND score < 0.5) AS false_rejects, round(avg(abs(score - passed::INT)), 6) AS mae FROM rec WHERE valid AND passed IS NOT NULL GROUP BY ALL""")
def q_confusion(t):
    r = _rec(t).filter("valid and passed is not null").withColumn("held_out", selection.held_out(F.col("id")))
    return r.groupBy("domain", "held_out").agg(F.count_if(~F.col("passed")).alias("negatives"), F.count_if(~F.col("passed") & (F.col("score") >= 0.5)).alias("false_accepts"), F.count_if("passed").alias("positives"), F.count_if(F.col("passed") & (F.col("score") < 0.5)).alias("false_rejects"), F.avg(F.abs(F.col("score") - F.col("passed").cast("int"))).alias("mae"))


@query("""WITH x AS (SELECT event_type, date_trunc('day', ts) AS d, list_sort(list(value) FILTER (value IS NOT NULL)) AS v FROM events GROUP BY ALL)
SELECT event_type, d AS day, round(v[floor(0.5 * (len(v) - 1))::INT + 1], 6) AS p50, round(v[floor(0.95 * (len(v) - 1))::INT + 1], 6) AS p95 FROM x WHERE len(v) > 0""")
def q_nearest_lower_percentile(t):
    return metrics.nearest_lower(t("events").withColumn("day", F.date_trunc("day", "ts")), ["event_type", "day"], "value", [0.5, 0.95], ["p50", "p95"])


@query(f"""WITH {REC} SELECT id, count(*) AS records, count(*) = {N} AND min(sample) = 0 AND max(sample) = {N} - 1
 AND bool_and(coalesce(valid AND score BETWEEN 0 AND 1 AND NOT (passed IS NOT NULL AND NOT coalesce(passed, true) AND score > 0), false)) AS accepted FROM rec GROUP BY id""")
def q_group_validation(t):
    return metrics.group_validation(_rec(t), N)


@query(f"""WITH {REC}, x AS (SELECT run, round(avg(score) FILTER (valid), 9) AS overall, count(*) AS saved, {", ".join(f"round(avg(score) FILTER (valid AND domain = '{d}'), 9) AS {d}" for d in screening.DOMAINS)} FROM rec GROUP BY run)
SELECT *, row_number() OVER (ORDER BY overall DESC NULLS LAST, run)::INT AS place FROM x""", places=9)
def q_leaderboard_pivot(t):
    return metrics.leaderboard(_rec(t), screening.DOMAINS)


@query(r"""SELECT t.response.finish_reason AS finish, count(*) AS turns, count(*) FILTER (regexp_full_match(coalesce(t.response.text, ''), '[ \t\n\r]*')) AS empty_turns, sum(coalesce(t.response.usage.completion_tokens, 0))::BIGINT AS completion,
 sum(coalesce(t.response.usage.prompt_tokens, 0))::BIGINT AS prompt, round(sum(CASE WHEN isnan(t.response.latency) THEN 0 ELSE coalesce(t.response.latency, 0) END), 3) AS seconds, round(sum(CASE WHEN isnan(t.grading_seconds) THEN 0 ELSE coalesce(t.grading_seconds, 0) END), 3) AS grading_seconds,
 count(*) FILTER (t.response.finish_reason = 'length') AS cap_hits FROM (SELECT unnest(turns) AS t FROM samples) WHERE t IS NOT NULL AND t.response IS NOT NULL GROUP BY 1""", places=3)
def q_operations_totals(t):
    x = t("samples").select(F.explode("turns").alias("t")).filter("t is not null and t.response is not null")
    zero = lambda c: F.sum(F.coalesce(F.col(c), F.lit(0)))
    secs = lambda c: F.sum(F.coalesce(F.nanvl(F.col(c), F.lit(0.0)), F.lit(0.0)))
    return x.groupBy(F.col("t.response.finish_reason").alias("finish")).agg(
        F.count("*").alias("turns"), F.count_if(F.coalesce(F.col("t.response.text"), F.lit("")).rlike(r"^[ \t\n\r]*$")).alias("empty_turns"), zero("t.response.usage.completion_tokens").alias("completion"), zero("t.response.usage.prompt_tokens").alias("prompt"),
        secs("t.response.latency").alias("seconds"), secs("t.grading_seconds").alias("grading_seconds"), F.count_if(F.col("t.response.finish_reason") == "length").alias("cap_hits"),
    )



# --- identities, selection, splits --------------------------------------------------------------------------------


@query(r"""SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY sha256(trim(regexp_replace(lower(text), '[ \t\n\r]+', ' ', 'g'))) ORDER BY doc_id) AS rn FROM documents WHERE text IS NOT NULL) WHERE rn = 1""")
def q_family_dedup_first(t):
    key = F.sha2(F.trim(F.regexp_replace(F.lower("text"), r"[ \t\n\r]+", " ")), 256)
    return selection.first_per_key(t("documents").filter("text is not null").select("doc_id", "source", key.alias("k")), "k", ["doc_id"]).select("doc_id", "source")


@query("""SELECT doc_id, sha256('[42,"' || doc_id || '"]') AS rk FROM documents""")
def q_seeded_rank(t):
    return t("documents").select("doc_id", selection.seeded_rank(42, F.col("doc_id")).alias("rk"))


_RK = """sha256('[42,"' || doc_id || '"]')"""
_TOP = f"x AS (SELECT doc_id, source, {_RK} AS rk, row_number() OVER (PARTITION BY source ORDER BY {_RK}, doc_id)::INT AS rn FROM documents)"


@query(f"WITH {_TOP} SELECT * FROM x WHERE rn <= 20")
def q_stratum_topn(t):
    return selection.top_per_stratum(t("documents").select("doc_id", "source"), "source", selection.seeded_rank(42, F.col("doc_id")), "doc_id", 20)


@query(f"WITH {_TOP}, y AS (SELECT *, row_number() OVER (ORDER BY rn, source)::INT AS pick FROM x) SELECT doc_id, source, rk, rn, pick FROM y WHERE pick <= 200")
def q_balanced_sample(t):
    return selection.balanced(t("documents").select("doc_id", "source"), "source", selection.seeded_rank(42, F.col("doc_id")), "doc_id", 200)


@query("SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id)::INT AS turn FROM events")
def q_domain_interleave(t):
    return selection.balance_order(t("events").select("event_id", "event_type"), "event_type", ["event_id"])


@query("SELECT event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn <= 50")
def q_first_n_per_task(t):
    w = Window.partitionBy("event_type").orderBy("ts", "event_id")
    return t("events").withColumn("rn", F.row_number().over(w)).filter("rn <= 50").select("event_id", "event_type")


@query("""WITH x AS (SELECT source, doc_id, sum(coalesce(n_chars, 0)) OVER (PARTITION BY source ORDER BY doc_id)::BIGINT AS used FROM documents), y AS (SELECT *, max((used > 20000)::INT) OVER (PARTITION BY source ORDER BY doc_id) AS o FROM x)
SELECT source, doc_id, used FROM y WHERE o = 0""")
def q_prefix_budget(t):
    return selection.prefix_budget(t("documents").select("source", "doc_id", "n_chars"), "source", ["doc_id"], "n_chars", 20_000).select("source", "doc_id", "used")


@query("WITH x AS (SELECT DISTINCT id, sample, unnest(range(len(turns)))::INT AS turn FROM samples WHERE id IS NOT NULL) SELECT id, sample, turn, ((7 + ('0x' || substr(id, 1, 8))::BIGINT + sample::BIGINT * 1009 + turn * 97) % 2147483648)::BIGINT AS seed FROM x")
def q_sampling_seed(t):
    s = t("samples").filter("id is not null").select("id", "sample", F.posexplode("turns").alias("turn", "t")).select("id", "sample", "turn").distinct()
    return s.select("id", "sample", "turn", selection.sampling_seed(7, F.col("id"), F.col("sample"), F.col("turn")).alias("seed"))


@query("""WITH x AS (SELECT task, id, list_sum(list_transform(messages, lambda m: coalesce(length(m.content), 0)))::BIGINT AS n FROM splits), y AS (SELECT *, row_number() OVER (PARTITION BY task ORDER BY n, id) AS rn FROM x) SELECT task, id, n FROM y WHERE rn = 1""")
def q_shortest_row(t):
    n = F.expr("aggregate(messages, 0L, (a, m) -> a + coalesce(length(m.content), 0))")
    return t("splits").select("task", "id", n.alias("n")).withColumn("rn", F.row_number().over(Window.partitionBy("task").orderBy("n", "id"))).filter("rn = 1").drop("rn")


@query("SELECT id, sha256(verification) AS digest FROM splits")
def q_line_digest(t):
    return t("splits").select("id", F.sha2("verification", 256).alias("digest"))


_KEYS = "k AS (SELECT DISTINCT split, key FROM (SELECT split, lower(trim(family_id)) AS key FROM splits UNION ALL SELECT split, lower(trim(unnest(family_aliases))) FROM splits) WHERE key IS NOT NULL AND key <> '')"


def _keyed(t) -> DataFrame:
    low = lambda c: F.lower(F.trim(c))
    keys = F.array_distinct(F.filter(F.concat(F.array(low(F.col("family_id"))), F.coalesce(F.transform("family_aliases", low), F.array().cast("array<string>"))), lambda k: k.isNotNull() & (k != "")))
    return t("splits").withColumn("keys", keys)


@query(f"WITH {_KEYS}, g AS (SELECT a.split AS a, b.split AS b FROM (SELECT DISTINCT split FROM splits) a JOIN (SELECT DISTINCT split FROM splits) b ON a.split < b.split), s AS (SELECT x.split AS a, y.split AS b, count(*) AS shared FROM k x JOIN k y ON x.key = y.key AND x.split < y.split GROUP BY ALL) SELECT a, b, coalesce(shared, 0) AS shared FROM g LEFT JOIN s USING (a, b)")
def q_overlap_counts(t):
    return overlap.overlap_counts(_keyed(t), "split", "keys")


@query(f"WITH {_KEYS}, h AS (SELECT DISTINCT key FROM k WHERE split <> 'rl_train'), bad AS (SELECT DISTINCT id FROM (SELECT id, lower(trim(family_id)) AS key FROM splits WHERE split = 'rl_train' UNION ALL SELECT id, lower(trim(unnest(family_aliases))) FROM splits WHERE split = 'rl_train') JOIN h USING (key)) SELECT DISTINCT id FROM splits WHERE split = 'rl_train' AND id NOT IN (SELECT id FROM bad)")
def q_heldout_antijoin(t):
    k = _keyed(t).select("id", "split", "keys")
    return overlap.held_out_filter(k.filter("split = 'rl_train'"), k.filter("split <> 'rl_train'"), "keys", "id").select("id").distinct()


@query("SELECT split, count(*) AS rows, count(DISTINCT id) AS ids, count(DISTINCT family_id) AS families, count(DISTINCT task) AS tasks FROM splits GROUP BY split")
def q_split_manifest(t):
    return splitting.manifest(t("splits"))


@query()
def q_family_keys(t):
    first = F.expr("element_at(filter(messages, m -> m.role = 'user'), 1).content")
    return t("splits").select("id", family_keys(F.col("family_id"), first, F.col("family_aliases")).alias("keys"))


@query(r"""WITH d AS (SELECT min(doc_id) AS class_id, text FROM documents WHERE text IS NOT NULL GROUP BY text),
w AS (SELECT class_id, regexp_extract_all(regexp_replace(lower(text), '([㐀-䶿一-鿿豈-﫿])', ' \1 ', 'g'), '[\p{L}\p{N}_]+') AS w FROM d),
s AS (SELECT class_id, list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS sh FROM w WHERE len(w) > 0),
e AS (SELECT class_id, len(sh) AS n, unnest(sh) AS k FROM s),
p AS (SELECT a.class_id AS a, b.class_id AS b FROM e a JOIN e b ON a.k = b.k AND a.class_id < b.class_id GROUP BY 1, 2 HAVING count(*) / (any_value(a.n) + any_value(b.n) - count(*))::DOUBLE >= 0.8),
l AS (SELECT id, count(*) AS links FROM (SELECT a AS id FROM p UNION ALL SELECT b FROM p) GROUP BY 1)
SELECT doc_id, class_id, coalesce(links, 0) AS links FROM documents JOIN d USING (text) LEFT JOIN l ON l.id = class_id""")
def q_near_dup_classes(t):
    return overlap.near_classes(t("documents"), "doc_id", "text")


@query()
def q_build_splits(t):
    last = F.expr("element_at(messages, -1).content")
    rows = selection.first_per_key(_keyed(t), "id", ["loaded_at"]).select("id", "family_id", F.col("keys").alias("family_keys"), last.alias("text"), "stratum", "task")
    return splitting.build_splits(rows, t("source_specs"))[0]


# --- screening and adapters ---------------------------------------------------------------------------------------

_DOMAINS = ", ".join(f"'{d}'" for d in screening.DOMAINS)
_INVALID = f"""CASE {" ".join(f"WHEN {c} IS NULL OR {c} = '' THEN 'no {c}'" for c in ("id", "family_id", "task", "domain", "verifier", "source"))} WHEN messages IS NULL OR len(messages) = 0 THEN 'no messages' WHEN domain NOT IN ({_DOMAINS}) THEN 'unknown domain'
 WHEN messages[-1].role IS DISTINCT FROM 'user' THEN 'last role' WHEN len(list_filter(messages, lambda m: m.role IN ('system', 'user', 'assistant') AND m.content IS NOT NULL)) < len(messages) THEN 'message' END"""


@query(f"SELECT id, {_INVALID} AS reason FROM splits")
def q_validate_record(t):
    return t("splits").select("id", screening.invalid_reason().alias("reason"))


@query("""WITH x AS (SELECT id, json_extract_string(verification, '$.answer') AS a, (verification::JSON -> '$.labels')::VARCHAR[] AS l FROM splits WHERE verifier = 'choice') SELECT id, coalesce(len(l) < 2 OR len(list_distinct(l)) < len(l) OR NOT list_contains(l, a), true) AS broken FROM x""")
def q_choice_metadata(t):
    x = t("splits").filter("verifier = 'choice'").select("id", F.get_json_object("verification", "$.answer").alias("a"), F.from_json(F.get_json_object("verification", "$.labels"), "array<string>").alias("l"))
    return x.select("id", screening.choice_problem(F.col("a"), F.col("l")).alias("broken"))


@query("""SELECT id AS old_id, count(*) AS n FROM splits WHERE verification LIKE '%num_words%' GROUP BY id""")
def q_repair_changes(t):
    _, changes = screening.repair_pattern(t("splits").select("id", "verification"), "num_words", "words")
    return changes.groupBy("old_id").agg(F.count("*").alias("n"))


@query("""SELECT id, CASE WHEN stratum LIKE 'planning%' THEN 'planning' WHEN max_new_tokens <= 0 THEN 'no budget' END AS reason FROM splits""")
def q_quarantine(t):
    kept, out = screening.quarantine(t("splits").select("id", "stratum", "max_new_tokens"), F.when(F.col("stratum").startswith("planning"), "planning").when(F.col("max_new_tokens") <= 0, "no budget"))
    return out.select("id", "reason").unionByName(kept.select("id", F.lit(None).cast("string").alias("reason")))


@query("SELECT id, list_aggregate(list_transform(messages, lambda m: m.role || ': ' || coalesce(m.content, '')), 'string_agg', chr(10)) AS text FROM splits")
def q_conversation_render(t):
    return t("splits").select("id", adapters.render_conversation(F.col("messages")).alias("text"))


@query("""WITH x AS (SELECT id, (verification::JSON -> '$.labels')::VARCHAR[] AS l FROM splits WHERE verifier = 'choice') SELECT id, list_aggregate(list_transform(l, lambda a: chr(10) || a || '. option ' || lower(a)), 'string_agg', '') AS options FROM x""")
def q_option_render(t):
    labels = F.from_json(F.get_json_object("verification", "$.labels"), "array<string>")
    x = t("splits").filter("verifier = 'choice'").select("id", labels.alias("l"))
    return x.select("id", adapters.render_options(F.col("l"), F.transform("l", lambda a: F.concat(F.lit("option "), F.lower(a)))).alias("options"))


@query("""SELECT id, split_part(json_extract_string(verification, '$.ids[0]'), ':', 1) AS rule FROM splits WHERE verifier = 'instruction' AND json_extract_string(verification, '$.ids[0]') IS NOT NULL""")
def q_rule_stratum(t):
    ids = F.from_json(F.get_json_object("verification", "$.ids"), "array<string>")
    return t("splits").filter("verifier = 'instruction'").select("id", adapters.rule_stratum(ids).alias("rule")).filter("rule is not null")


@query(r"""SELECT CASE WHEN language IS NULL THEN 'unknown' ELSE coalesce(map {'en':'en','eng':'en','english':'en','de':'de','deu':'de','ger':'de','german':'de','fr':'fr','fra':'fr','fre':'fr','french':'fr','es':'es','spa':'es','spanish':'es','ru':'ru','rus':'ru','russian':'ru','zh':'zh','zho':'zh','chi':'zh','chinese':'zh'}[regexp_extract(lower(trim(language)), '^([a-z]+)', 1)], 'unknown') END AS language,
 nullif(regexp_replace(lower(stratum), '[\s\-_]+', '', 'g'), '') AS stratum, count(*) AS n FROM splits GROUP BY 1, 2""")
def q_label_folding(t):
    return t("splits").groupBy(language_code(F.col("language")).alias("language"), label_key(F.col("stratum")).alias("stratum")).agg(F.count("*").alias("n"))


@query("SELECT DISTINCT task FROM source_specs EXCEPT SELECT DISTINCT task FROM splits")
def q_task_difference(t):
    return t("source_specs").select("task").distinct().exceptAll(t("splits").select("task").distinct())


# --- texts and grades ---------------------------------------------------------------------------------------------


def _last(t) -> DataFrame:
    return metrics.last_write(t("samples").filter("id is not null and sample is not null"), ["id", "sample"], [F.desc("stored_at"), F.desc("finished_at"), F.desc("run")])


def _turns(t) -> DataFrame:
    return _last(t).select("id", "sample", F.posexplode("turns").alias("turn", "t")).filter("t is not null and t.response is not null")


def _texts(t, fn, schema: str) -> DataFrame:
    """fn over response texts in Arrow batches."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [fn(x) if isinstance(x, str) else None for x in pdf["text"]]
            yield pd.DataFrame({"id": pdf["id"], "sample": pdf["sample"], "turn": pdf["turn"], "value": pd.Series(got, index=pdf.index, dtype=object)})

    return _turns(t).select("id", "sample", "turn", F.col("t.response.text").alias("text")).mapInPandas(run, f"id string, sample int, turn int, value {schema}")


@query()
def q_final_answer(t):
    return _texts(t, X.extract_final, "string")


@query()
def q_boxed(t):
    return _texts(t, X.last_boxed, "string").filter("value is not null")


@query()
def q_structured_candidates(t):
    return _texts(t, X.structured_candidates, "array<string>")


_GRAMS = """CASE WHEN len(w) < 4 THEN 0.0::DOUBLE ELSE round(1 - len(list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))) / (len(w) - 3)::DOUBLE, 6) END"""
_LAST = "last AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id, sample ORDER BY stored_at DESC, finished_at DESC, run DESC) AS rn FROM samples WHERE id IS NOT NULL AND sample IS NOT NULL) WHERE rn = 1)"
_JOINED = "coalesce(array_to_string(list_transform(list_filter(turns, lambda t: t.response.text IS NOT NULL), lambda t: t.response.text), chr(10)), '')"
_SPLIT = r"list_filter(regexp_split_to_array({0}, '[\s\x1c-\x1f\x0b\p{{Z}}\x{{85}}]+'), lambda w: w <> '')"


@query(f"WITH {_LAST}, x AS (SELECT id, sample, {_SPLIT.format(_JOINED)} AS w FROM last) SELECT id, sample, {_GRAMS} AS value FROM x")
def q_repetition_4gram(t):
    return metrics.repeated_grams(_last(t).select("id", "sample", metrics.joined_text().alias("text")), "text", "value").select("id", "sample", "value")


@query(f"""WITH {REC}, {_LAST}, g AS (SELECT id, sample, {_SPLIT.format(_JOINED)} AS w FROM last), y AS (SELECT id, sample, {_GRAMS} AS repetition FROM g),
z AS (SELECT id, sample, score, repetition, coalesce(list_sum(list_transform(turns, lambda t: coalesce(t.response.usage.completion_tokens, 0))), 0)::BIGINT AS tokens FROM rec JOIN y USING (id, sample) JOIN last USING (id, sample) WHERE rec.valid AND score >= 0.75)
SELECT * FROM (SELECT *, row_number() OVER (ORDER BY repetition DESC, tokens DESC, id, sample)::INT AS place FROM z) WHERE place <= 100""")
def q_audit_queue_topk(t):
    return metrics.audit_queue(_rec(t), _last(t)).select("id", "sample", "score", "repetition", "tokens", "place")


_XY = "CASE WHEN count(*) FILTER (valid) >= 3 THEN round(covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0), 6) END"


@query(f"""WITH {REC}, {_LAST}, g AS (SELECT id, sample, {_SPLIT.format(_JOINED)} AS w FROM last),
z AS (SELECT domain, valid, status, capped, CASE WHEN valid THEN score END AS s, CASE WHEN valid THEN {_GRAMS} END AS r, CASE WHEN valid THEN coalesce(list_sum(list_transform(turns, lambda t: coalesce(t.response.usage.completion_tokens, 0))), 0)::DOUBLE END AS k
 FROM rec JOIN g USING (id, sample) JOIN (SELECT id, sample, turns FROM last) USING (id, sample))
SELECT domain, count(*) AS samples, count(*) FILTER (NOT valid) AS errors, count(*) FILTER (capped) AS cap_hits, {_XY.format(x="s", y="k")} AS score_length, {_XY.format(x="s", y="r")} AS score_repetition FROM z GROUP BY domain""")
def q_reliability(t):
    return metrics.reliability(_rec(t), _last(t))


@query(f"WITH {REC} SELECT domain, score, count(*) AS n FROM rec WHERE valid GROUP BY ALL")
def q_score_histogram(t):
    return _rec(t).filter("valid").groupBy("domain", "score").agg(F.count("*").alias("n"))


@query()
def q_normalized_text(t):
    return t("documents").select("doc_id", normalized_col("text").alias("text"))


def _graded(t) -> DataFrame:
    """Rule stage over single-turn responses with their prompts."""
    p = selection.first_per_key(t("splits").select("id", "verifier", "verification", "binary", F.lower(F.trim("domain")).alias("domain"), F.expr("element_at(messages, -1).content").alias("prompt"), "loaded_at"), "id", ["loaded_at"]).drop("loaded_at")
    x = _turns(t).select("id", "sample", "turn", F.col("t.response.text").alias("text"), F.col("t.response.finish_reason").alias("finish"))
    return grading.grade(x.join(p, "id"), ["id", "sample", "turn"])


@query()
def q_grade(t):
    return _graded(t)


@query()
def q_grade_report(t):
    return _graded(t).groupBy("status", "reason").agg(F.count("*").alias("n"), F.avg("score").alias("score"))


# --- windows and request streams ----------------------------------------------------------------------------------


@query("""WITH x AS (SELECT o_custkey, o_orderkey, o_orderdate, lag(o_orderdate + INTERVAL 30 DAY) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev FROM orders) SELECT o_custkey, count(*) AS orders, count(*) FILTER (prev > o_orderdate) AS overlaps FROM x GROUP BY o_custkey""")
def q_calendar_overlap(t):
    prev = F.lag(F.expr("o_orderdate + INTERVAL 30 DAYS")).over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    return t("orders").select("o_custkey", "o_orderdate", prev.alias("prev")).groupBy("o_custkey").agg(F.count("*").alias("orders"), F.count_if(F.col("prev") > F.col("o_orderdate")).alias("overlaps"))


@query("WITH x AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, avg(value) AS mean, max(value) AS most, list_sort(list(value) FILTER (value IS NOT NULL)) AS v FROM events GROUP BY 1, 2) SELECT start, event_type, n, round(mean, 6) AS mean, round(most, 6) AS most, round(v[floor(0.5 * (len(v) - 1))::INT + 1], 6) AS p50, round(v[floor(0.95 * (len(v) - 1))::INT + 1], 6) AS p95 FROM x")
def q_stats_window(t):
    return requests.interval_stats(t("events"), "ts", "event_type", "value")


@query("""WITH x AS (SELECT event_type, floor(epoch(ts) / 3600)::BIGINT AS slot, min(ts) AS first_at, count(*) AS n FROM events GROUP BY 1, 2) SELECT event_type, first_at, coalesce(lag(n) OVER (PARTITION BY event_type ORDER BY slot) - 1, 0) AS held_back FROM x""")
def q_error_throttle(t):
    return requests.throttled(t("events"), "ts", "event_type")


@query("""WITH x AS (SELECT user_id, event_id, event_type, first_value(event_type) OVER w AS f, row_number() OVER w AS rn FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) SELECT user_id, event_id, CASE WHEN rn = 1 THEN 'accepted' WHEN event_type = f THEN 'repeat' ELSE 'conflict' END AS state FROM x""")
def q_request_conflict(t):
    return requests.request_states(t("events"), "user_id", "event_type", ["ts", "event_id"]).select("user_id", "event_id", "state")
