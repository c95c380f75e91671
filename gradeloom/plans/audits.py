"""Queries of the protocol rollups, run audits, screening, run selection, versions and services, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeloom.functions.ids import json_digest
from gradeloom.operators import grading, metrics, protocol, screening, selection, versions
from gradeloom.plans.catalogue import _SPLIT, REC, N, _keyed, _last, _rec
from gradeloom.plans.registry import query
from gradeloom.streaming import requests

KS = (1, 2)
#: The protocol's weights, and weights for tasks of these tables.
WEIGHTS = protocol.TASK_WEIGHTS | {"sumtales": 0.5, "olymp_steps": 0.5, "pickone": 0.25, "aliasquiz": 0.5, "rulekeep": 0.5, "turnrules": 0.5, "dialogpins": 0.5}
QUALITY = "genbench"

_PLANNED = """planned AS (SELECT id, x.task AS task, x.domain AS domain, x.stratum AS stratum, x.bin AS bin, x.length_bucket AS length_bucket FROM
 (SELECT id, min(struct_pack(loaded_at := loaded_at, task := task, domain := lower(trim(domain)), stratum := coalesce(stratum, 'default'), bin := coalesce("binary", true), length_bucket := length_bucket)) AS x FROM splits WHERE id IS NOT NULL GROUP BY id))"""
_PROMPT = f"""WITH {REC}, {_PLANNED},
g AS (SELECT id, count(*) AS saved, count(*) FILTER (valid) AS valid, count(*) FILTER (capped) AS capped, count(*) FILTER (valid AND capped) AS cut, avg(CASE WHEN valid THEN CASE WHEN capped THEN 0.0::DOUBLE ELSE score END END) AS m,
 count(*) FILTER (valid AND passed AND NOT capped) AS ok FROM rec WHERE sample >= 0 AND sample < {N} GROUP BY id),
p AS (SELECT planned.*, coalesce(saved, 0) AS saved, coalesce(valid, 0) AS valid, coalesce(capped, 0) AS capped, CASE WHEN valid = {N} THEN m END AS score, CASE WHEN valid = {N} THEN cut END AS cut, CASE WHEN valid = {N} AND bin THEN ok END AS passes FROM planned LEFT JOIN g USING (id))"""
_TASK = f"""{_PROMPT}, t AS (SELECT domain, task, count(*) AS planned, count(score) AS prompts, avg(score) AS score, stddev_samp(score) / sqrt(nullif(count(score), 0)::DOUBLE) AS stderr, coalesce(sum(cut), 0)::BIGINT AS truncated,
 avg(passes / 2.0::DOUBLE) AS pass_at_1, avg(CASE WHEN passes >= 1 THEN 1.0::DOUBLE WHEN passes = 0 THEN 0.0::DOUBLE END) AS pass_at_2 FROM p GROUP BY domain, task)"""
_LONG = "CASE WHEN list_contains(['rag', 'icl'], array_to_string(string_split(task, '_')[least(3, len(string_split(task, '_'))):], '_')) THEN 0.3::DOUBLE ELSE 0.04::DOUBLE END"
_WEIGHT = f"""CASE WHEN domain = 'long_context' THEN {_LONG} {" ".join(f"WHEN task = '{t}' THEN {w}::DOUBLE" for t, w in WEIGHTS.items())} ELSE 1.0::DOUBLE END"""
_STRATA = f"{_TASK}, s AS (SELECT task, stratum, count(*) AS prompts, avg(score) AS score FROM p WHERE score IS NOT NULL GROUP BY task, stratum)"
_GROUP = """CASE WHEN string_split(stratum, '/')[2] = 'role_playing' THEN 'roleplay' WHEN string_split(stratum, '/')[1] = 'planning' OR string_split(stratum, '/')[2] = 'replanning' THEN 'planning'
 WHEN string_split(stratum, '/')[1] = 'refinement' OR string_split(stratum, '/')[2] IN ('writing_a_speech', 'education_content_creation', 'instruction_data_creation') THEN 'writing' ELSE 'chat' END"""
_GROUPS = f"""{_STRATA}, q AS (SELECT {_GROUP} AS "group", count(*) AS strata, avg(score) AS score FROM s WHERE task = '{QUALITY}' GROUP BY 1),
qw AS (SELECT *, CASE "group" WHEN 'roleplay' THEN 0.1::DOUBLE ELSE 0.3::DOUBLE END AS weight FROM q)"""
_MEAN = "sum(w * {0}) / nullif(sum(w), 0)"
_DOMAIN = f"""{_GROUPS}, tw AS (SELECT *, CASE WHEN prompts > 0 THEN {_WEIGHT} END AS w FROM t),
d0 AS (SELECT domain, count(*) AS tasks, count(*) FILTER (prompts > 0) AS scored_tasks, sum(planned)::BIGINT AS planned, sum(prompts)::BIGINT AS prompts, {_MEAN.format("score")} AS score, bool_and(prompts = planned) AS complete,
 {", ".join(f"CASE WHEN bool_and(pass_at_{k} IS NOT NULL OR prompts = 0) THEN {_MEAN.format(f'pass_at_{k}')} END AS pass_at_{k}" for k in KS)} FROM tw GROUP BY domain),
d AS (SELECT d0.* REPLACE (CASE WHEN domain = 'quality' AND score IS NOT NULL AND (SELECT count(*) FROM qw) = 4 THEN (SELECT sum(weight * score) FROM qw) ELSE score END AS score) FROM d0)"""


def _planned(t) -> DataFrame:
    return protocol.planned_prompts(t("splits"))


def _scores(t) -> DataFrame:
    return protocol.prompt_scores(_planned(t), _rec(t), N)


def _tasks(t) -> DataFrame:
    return protocol.task_scores(_scores(t), N, KS)


def _groups(t) -> DataFrame:
    return protocol.quality_groups(protocol.stratum_scores(_scores(t)), QUALITY)


def _domains(t) -> DataFrame:
    return protocol.domain_scores(_tasks(t), _groups(t), KS, WEIGHTS)


@query(f"{_PROMPT} SELECT id, task, domain, stratum, bin AS \"binary\", length_bucket, saved, valid, capped, round(score, 6) AS score, cut, passes FROM p")
def q_protocol_prompts(t):
    return _scores(t)


@query(f"{_TASK} SELECT * REPLACE (round(score, 6) AS score, round(stderr, 6) AS stderr, round(pass_at_1, 6) AS pass_at_1, round(pass_at_2, 6) AS pass_at_2) FROM t")
def q_protocol_tasks(t):
    return _tasks(t)


@query(f"{_STRATA} SELECT task, stratum, prompts, round(score, 6) AS score FROM s")
def q_strata_rollup(t):
    return protocol.stratum_scores(_scores(t))


@query(f'{_GROUPS} SELECT "group", strata, round(score, 6) AS score, weight FROM qw')
def q_quality_override(t):
    return _groups(t)


@query(f"{_DOMAIN} SELECT * REPLACE (round(score, 6) AS score, round(pass_at_1, 6) AS pass_at_1, round(pass_at_2, 6) AS pass_at_2) FROM d")
def q_domain_rollup(t):
    return _domains(t)


_PLAN = ", ".join(f"({i}, '{d}')" for i, d in enumerate(screening.DOMAINS))


@query(f"""{_DOMAIN}, plan(place, domain) AS (VALUES {_PLAN}) SELECT round(100 * avg(score), 6) AS score, round(100 * avg(pass_at_1), 6) AS pass_at_1, round(100 * avg(pass_at_2), 6) AS pass_at_2, count(score) AS domains, bool_and(coalesce(complete, false)) AS complete,
 coalesce(string_agg(CASE WHEN score IS NULL THEN domain END, ',' ORDER BY place), '') AS missing, coalesce(string_agg(CASE WHEN score IS NOT NULL AND NOT complete THEN domain END, ',' ORDER BY place), '') AS partial FROM plan LEFT JOIN d USING (domain)""")
def q_aggregate(t):
    return protocol.aggregate_scores(_domains(t), KS)


@query(f"""{_TASK}, h AS (SELECT length_bucket, domain, task, count(*) AS here FROM p WHERE length_bucket IS NOT NULL AND length_bucket <> 0 GROUP BY ALL),
j AS (SELECT h.*, t.prompts, t.score, t.pass_at_1, t.pass_at_2, {_LONG.replace("task", "h.task")} AS w FROM h LEFT JOIN t USING (domain, task)),
l AS (SELECT length_bucket, sum(here)::BIGINT AS prompts, {", ".join(f"CASE WHEN bool_and(coalesce(prompts = here, false)) THEN round({_MEAN.format(c)}, 6) END AS {c}" for c in ("score", "pass_at_1", "pass_at_2"))} FROM j GROUP BY length_bucket),
u AS (SELECT id, unnest(turns).response.usage.prompt_tokens AS x FROM (SELECT *, row_number() OVER (PARTITION BY id, sample ORDER BY stored_at DESC, finished_at DESC, run DESC) AS rn FROM samples WHERE id IS NOT NULL AND sample IS NOT NULL) WHERE rn = 1),
m AS (SELECT length_bucket, min(x) AS least_tokens, max(x) AS most_tokens FROM u JOIN planned USING (id) WHERE length_bucket IS NOT NULL GROUP BY length_bucket)
SELECT l.*, least_tokens, most_tokens FROM l LEFT JOIN m USING (length_bucket)""")
def q_length_rollup(t):
    p = _scores(t)
    turns = _last(t).select("id", F.explode(F.transform("turns", lambda x: x.response.usage.prompt_tokens)).alias("prompt_tokens"))
    return protocol.length_scores(p, protocol.task_scores(p, N, KS), turns, KS)


@query(f"{_PROMPT} SELECT sum(saved - valid)::BIGINT AS errors, count(*) FILTER (score IS NULL) AS incomplete, sum(capped)::BIGINT AS truncated, sum(capped) = 0 AS truncation_free, sum(saved - valid) = 0 AND count(*) FILTER (score IS NULL) = 0 AS comparable FROM p")
def q_run_state(t):
    return protocol.run_state(_scores(t))


_AUDIT = f"""{_PROMPT}, pf AS (SELECT p.*, (SELECT count(*) FROM rec r WHERE r.id = p.id AND r.sample >= 0 AND r.sample < {N} AND r.valid AND NOT r.passed) AS failed FROM p),
sm AS (SELECT r.*, planned.bin FROM rec r JOIN planned USING (id) WHERE sample >= 0 AND sample < {N}),
tn AS (SELECT planned.task, planned.domain, x.response.finish_reason AS finish, regexp_full_match(coalesce(x.response.text, ''), '[\\s\\p{{Z}}]*') AS empty FROM
 (SELECT id, unnest(turns) AS x FROM (SELECT *, row_number() OVER (PARTITION BY id, sample ORDER BY stored_at DESC, finished_at DESC, run DESC) AS rn FROM samples WHERE id IS NOT NULL AND sample >= 0 AND sample < {N}) WHERE rn = 1) JOIN planned USING (id) WHERE x.response IS NOT NULL),
a1 AS (SELECT domain, task, count(*) AS prompts, count(*) * {N} AS expected, count(score) AS complete, count(*) FILTER (bin AND score IS NOT NULL AND failed = {N}) AS all_failed FROM pf GROUP BY GROUPING SETS ((), (domain), (task))),
a2 AS (SELECT domain, task, count(*) AS saved, count(*) FILTER (valid) AS valid, count(*) FILTER (status = 'error') AS errors, count(*) FILTER (NOT valid AND NOT coalesce(status = 'error', false)) AS pending, count(*) FILTER (n_turns > 0) AS generated, count(*) FILTER (valid AND bin AND passed) AS passed,
 count(*) FILTER (valid AND bin AND NOT passed) AS failed, count(*) FILTER (valid AND NOT bin) AS continuous, count(*) FILTER (capped) AS truncated FROM sm GROUP BY GROUPING SETS ((), (domain), (task))),
a3 AS (SELECT domain, task, count(*) AS turns, count(*) FILTER (finish = 'length') AS truncated_turns, count(*) FILTER (empty) AS empty_turns FROM tn GROUP BY GROUPING SETS ((), (domain), (task))),
au AS (SELECT a1.*, {", ".join(f"coalesce({c}, 0) AS {c}" for c in "saved valid errors pending generated passed failed continuous truncated turns truncated_turns empty_turns".split())} FROM a1 LEFT JOIN a2 ON a1.domain IS NOT DISTINCT FROM a2.domain AND a1.task IS NOT DISTINCT FROM a2.task LEFT JOIN a3 ON a1.domain IS NOT DISTINCT FROM a3.domain AND a1.task IS NOT DISTINCT FROM a3.task)"""


def _expected(t) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Prompts, expected samples and their turns of a run, as the audit counts them."""
    plan = _planned(t)
    rec = _rec(t).filter((F.col("sample") >= 0) & (F.col("sample") < N))
    samples = rec.join(plan.select("id", "binary"), "id")
    failed = samples.filter("valid and not passed").groupBy("id").agg(F.count("*").alias("failed"))
    prompts = _scores(t).join(failed, "id", "left").fillna(0, ["failed"])
    x = _last(t).filter((F.col("sample") >= 0) & (F.col("sample") < N)).select("id", F.explode("turns").alias("x")).filter("x.response is not null")
    numbers = {"prompt_tokens": "x.response.usage.prompt_tokens", "completion_tokens": "x.response.usage.completion_tokens", "reasoning_tokens": "x.response.usage.reasoning_tokens", "latency": "x.response.latency", "grading_seconds": "x.grading_seconds", "output_cap": "x.response.request.max_tokens"}
    empty = F.coalesce(F.col("x.response.text"), F.lit("")).rlike(r"(?U)^\s*$")
    turns = x.select("id", F.col("x.response.finish_reason").alias("finish"), empty.alias("empty"), *[F.col(c).alias(n) for n, c in numbers.items()]).join(plan.select("id", "task", "domain"), "id")
    return prompts, samples, turns


_COUNTS = "domain, task, prompts, expected, complete, all_failed, saved, valid, errors, pending, generated, passed, failed, continuous, truncated, turns, truncated_turns, empty_turns, expected - saved AS missing, prompts - complete AS incomplete, round(passed / nullif(passed + failed, 0)::DOUBLE, 6) AS pass_rate, round(truncated / nullif(generated, 0)::DOUBLE, 6) AS truncated_rate"


@query(f"{_AUDIT} SELECT {_COUNTS} FROM au")
def q_audit_counts(t):
    return protocol.audit_counts(*_expected(t), N)


@query(f"{_AUDIT} SELECT task, complete = prompts AS complete, failed > 0 AS with_failures, errors > 0 AS with_errors, truncated > 0 AS with_truncation, failed > 0 AND passed = 0 AND complete = prompts AS no_pass_when_complete FROM au WHERE task IS NOT NULL")
def q_audit_task_lists(t):
    return protocol.task_lists(protocol.audit_counts(*_expected(t), N, by=[("task",)]))


@query(f"{_AUDIT}, c AS (SELECT domain, coalesce(finish, 'none') AS finish, count(*) AS n FROM tn GROUP BY ALL) SELECT *, row_number() OVER (PARTITION BY domain ORDER BY n DESC, finish)::INT AS place FROM c")
def q_finish_counts(t):
    return protocol.counted_values(_expected(t)[2], ["domain"], "finish", "none")


@query(f"{_AUDIT}, c AS (SELECT task, coalesce(error, 'unspecified') AS error, count(*) AS n FROM sm WHERE status = 'error' GROUP BY ALL) SELECT *, row_number() OVER (PARTITION BY task ORDER BY n DESC, error)::INT AS place FROM c")
def q_error_messages(t):
    return protocol.counted_values(_expected(t)[1].filter("status = 'error'"), ["task"], "error", "unspecified")


_V = "CASE WHEN {0} IS NOT NULL AND NOT isnan({0}::DOUBLE) AND {0} >= 0 AND {0}::DOUBLE < 'infinity'::DOUBLE THEN {0}::DOUBLE END"
_DIST = """count(v) AS n, count(*) - count(v) AS missing, round(sum(v), 6) AS total, round(min(v), 6) AS least, round(max(v), 6) AS most, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS deviation, round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.9), 6) AS p90, round(quantile_cont(v, 0.95), 6) AS p95, round(quantile_cont(v, 0.99), 6) AS p99"""
_NUMBERS = {"prompt_tokens": "x.response.usage.prompt_tokens", "completion_tokens": "x.response.usage.completion_tokens", "reasoning_tokens": "x.response.usage.reasoning_tokens", "latency": "x.response.latency", "grading_seconds": "x.grading_seconds"}
_CAPPED = f"{_V.format('x.response.usage.completion_tokens')} / nullif({_V.format('x.response.request.max_tokens')}, 0)"


@query(f"""{_AUDIT}, o AS (SELECT planned.domain, x FROM (SELECT id, unnest(turns) AS x FROM (SELECT *, row_number() OVER (PARTITION BY id, sample ORDER BY stored_at DESC, finished_at DESC, run DESC) AS rn FROM samples WHERE id IS NOT NULL AND sample >= 0 AND sample < {N}) WHERE rn = 1) JOIN planned USING (id) WHERE x.response IS NOT NULL),
e AS ({" UNION ALL ".join(f"SELECT domain, '{n}' AS number, {_V.format(c)} AS v FROM o" for n, c in _NUMBERS.items())} UNION ALL SELECT domain, 'cap_used', {_CAPPED} FROM o) SELECT domain, number, {_DIST} FROM e GROUP BY domain, number""")
def q_turn_distributions(t):
    return metrics.distribution(protocol.turn_numbers(_expected(t)[2]), "value", ["domain", "number"])


@query(f"""{_AUDIT}, j AS (SELECT r.grade.status AS status, r.sample AS attempt, x.response.finish_reason AS finish, contains(x.response.text, '```') AS fenced, {_V.format("x.response.usage.completion_tokens")} AS tok, {_V.format("x.response.latency")} AS lat
 FROM (SELECT *, unnest(turns) AS x FROM (SELECT *, row_number() OVER (PARTITION BY id, sample ORDER BY stored_at DESC, finished_at DESC, run DESC) AS rn FROM samples WHERE id IS NOT NULL AND sample IS NOT NULL) WHERE rn = 1) r WHERE x.response IS NOT NULL)
SELECT count(*) AS attempts, count(*) FILTER (coalesce(status <> 'valid', true)) AS failed, count(*) FILTER (attempt > 0) AS retries, count(*) FILTER (fenced) AS fenced, count(*) FILTER (finish = 'length') AS cut_off, coalesce(sum(tok), 0)::DOUBLE AS completion_tokens, round(coalesce(sum(lat), 0)::DOUBLE, 3) AS seconds FROM j""", places=3)
def q_judge_stats(t):
    """The statistics of judge attempts, over the stored answers in their stead."""
    x = _last(t).select(F.col("grade.status").alias("status"), F.col("sample").alias("attempt"), F.explode("turns").alias("x")).filter("x.response is not null")
    return protocol.judge_stats(x.select("status", "attempt", F.col("x.response.finish_reason").alias("finish"), F.col("x.response.text").contains("```").alias("fenced"), F.col("x.response.usage.completion_tokens").alias("completion_tokens"), F.col("x.response.latency").alias("latency")))


@query(f"""WITH {REC}, {_PLANNED}, f AS (SELECT id, max(coalesce(len(turns), 1)) AS expected FROM splits WHERE id IS NOT NULL GROUP BY id),
l AS (SELECT id, sample, turns[-1].response.finish_reason AS last_finish FROM (SELECT *, row_number() OVER (PARTITION BY id, sample ORDER BY stored_at DESC, finished_at DESC, run DESC) AS rn FROM samples WHERE id IS NOT NULL AND sample IS NOT NULL) WHERE rn = 1),
v AS (SELECT rec.*, greatest(coalesce(expected, 1), 1) AS expected, last_finish FROM rec JOIN l USING (id, sample) LEFT JOIN f USING (id) WHERE valid)
SELECT id, sample, 'incomplete trajectory' AS issue FROM v WHERE n_turns = 0 OR (n_turns <> expected AND NOT (coalesce(last_finish = 'length', false) AND n_turns < expected)) UNION ALL SELECT id, sample, 'capped but scored' FROM v WHERE capped AND (score <> 0 OR coalesce(passed, false))""")
def q_policy_violations(t):
    last = _last(t).select("id", "sample", F.try_element_at("turns", F.lit(-1))["response"]["finish_reason"].alias("last_finish"))
    turns = t("splits").filter("id is not null").groupBy("id").agg(F.greatest(F.max(F.coalesce(F.size("turns"), F.lit(1))), F.lit(1)).alias("expected"))
    return protocol.policy_violations(_rec(t).join(last, ["id", "sample"]), turns)


@query(f"""WITH {_PLANNED}, x AS (SELECT *, count(*) OVER (PARTITION BY id, sample) AS n FROM samples WHERE id IS NOT NULL), y AS (SELECT x.id, x.sample, CASE WHEN p.id IS NULL THEN 'unexpected id' WHEN NOT coalesce(sample BETWEEN 0 AND {N} - 1, false) THEN 'sample index' WHEN n > 1 THEN 'stored more than once'
 WHEN x.task IS DISTINCT FROM p.task THEN 'task' WHEN lower(trim(x.domain)) IS DISTINCT FROM p.domain THEN 'domain' WHEN grade.status IS NOT NULL AND grade.status NOT IN ('valid', 'error') THEN 'grade status'
 WHEN grade.status = 'valid' AND NOT coalesce(grade.score IS NOT NULL AND NOT isnan(grade.score) AND grade.score BETWEEN 0 AND 1, false) THEN 'score' WHEN grade.status = 'valid' AND p.bin AND grade.passed IS NULL THEN 'no verdict' END AS issue FROM x LEFT JOIN planned p ON p.id = x.id)
SELECT * FROM y WHERE issue IS NOT NULL""")
def q_integrity(t):
    stored = protocol.compact_records(t("samples").filter("id is not null"))
    return protocol.integrity_issues(stored, _planned(t), N)


@query(f"""WITH l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, sample ORDER BY stored_at DESC, finished_at DESC, run DESC) AS rn FROM samples WHERE id IS NOT NULL AND sample IS NOT NULL) WHERE rn = 1)
SELECT id, sample, grade.status AS status, coalesce(len(turns), 0)::INT AS n, coalesce(list_sum(list_transform(turns, lambda t: coalesce(t.response.request.max_tokens, 0))), 0)::BIGINT AS caps, coalesce(len(list_filter(turns, lambda t: regexp_full_match(coalesce(t.response.text, ''), '[\\s\\p{{Z}}]*'))), 0)::INT AS empty FROM l""")
def q_compact_records(t):
    d = protocol.compact_records(_last(t))
    caps = F.coalesce(F.expr("aggregate(turns, 0L, (a, x) -> a + coalesce(x.output_cap, 0))"), F.lit(0))
    return d.select("id", "sample", "status", F.coalesce(F.size("turns"), F.lit(0)).alias("n"), caps.alias("caps"), F.coalesce(F.size(F.filter("turns", lambda x: x["empty"])), F.lit(0)).alias("empty"))


# --- screening, admission, selection --------------------------------------------------------------------------------


def _rx(pattern: str) -> str:
    return "'" + pattern.replace("(?iU)", "").replace("'", "''") + "'"


_SAID = "list_transform(messages, lambda m: coalesce(m.content, ''))"


def _reject(messages: str, gold: str) -> str:
    text = f"array_to_string(list_transform({messages}, lambda m: coalesce(m.content, '')), chr(10))"
    opened = "verifier IN ('quality', 'rubric', 'instruction', 'structure', 'calendar')"
    match = lambda c, p: f"regexp_matches({c}, {_rx(p)}, 'i')"
    return f"""CASE WHEN {match(f"coalesce({gold}, '')", screening.REFUSAL)} THEN 'refusal_reference_target' WHEN len(list_filter({messages}, lambda m: m.role = 'assistant' AND {match("coalesce(m.content, '')", screening.REFUSAL)})) > 0 THEN 'refusal_in_conversation_history'
 WHEN {opened} AND {match(text, screening.META_PROMPT)} THEN 'adversarial_meta_prompt' WHEN {opened} AND {match(text, screening.NO_ANSWER)} THEN 'explicit_nonanswer_instruction' WHEN {opened} AND {match(text, screening.REFUSAL)} THEN 'quoted_refusal_example_requires_review' END"""


_GOLD_TEXT = "CASE WHEN json_type(verification::JSON, '$.{0}') = 'VARCHAR' THEN json_extract_string(verification, '$.{0}') END"
_SCREEN = _reject("messages", f"concat_ws(chr(10), {_GOLD_TEXT.format('answer')}, {_GOLD_TEXT.format('reference')})")


@query(f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY id, sample ORDER BY stored_at DESC, finished_at DESC, run DESC) AS rn FROM samples WHERE id IS NOT NULL AND sample IS NOT NULL),
v AS (SELECT id, min(verifier) AS verifier FROM splits GROUP BY id), x AS (SELECT id, sample, generate_subscripts(turns, 1)::INT - 1 AS turn, unnest(turns) AS t FROM r WHERE rn = 1),
y AS (SELECT x.id, sample, turn, verifier, t.response.text AS text, CASE WHEN turn % 2 = 0 THEN [{{'role': 'user', 'content': t.response.text}}] ELSE [{{'role': 'assistant', 'content': t.response.text}}] END AS messages FROM x JOIN v ON v.id = x.id WHERE t.response.text IS NOT NULL)
SELECT id, sample, turn, {_reject("messages", "CASE WHEN sample % 2 = 1 THEN text END")} AS reason FROM y""")
def q_rejection_reason(t):
    """Screening over stored answers, put in the place of a reference (odd samples), of a prompt or of an earlier answer."""
    v = t("splits").groupBy("id").agg(F.min("verifier").alias("verifier"))
    x = _last(t).select("id", "sample", F.posexplode("turns").alias("turn", "x")).select("id", "sample", "turn", F.col("x.response.text").alias("text")).filter("text is not null")
    role = F.when(F.col("turn") % 2 == 0, "user").otherwise("assistant")
    gold = F.when(F.col("sample") % 2 == 1, F.to_json(F.struct(F.col("text").alias("answer")))).otherwise("{}")
    rows = x.join(v, "id").withColumn("messages", F.array(F.struct(role.alias("role"), F.col("text").alias("content")))).withColumn("verification", gold)
    return rows.select("id", "sample", "turn", screening.rejection_reason().alias("reason"))


KNOWN = ("length:words", "length:sentences", "keywords:include", "keywords:exclude", "format:bullets", "casing:upper")


@query(f"""WITH x AS (SELECT id, verifier, list_filter(list_concat(coalesce((verification::JSON -> '$.ids')::VARCHAR[], []), coalesce(flatten(list_transform(turns, lambda t: t.ids)), [])), lambda i: i NOT IN ({", ".join(f"'{k}'" for k in KNOWN)})) AS odd, (verification::JSON -> '$.checks')::JSON[] AS checks,
 list_filter(regexp_extract_all(verification, '"constraint": ?"([^"]*)"', 1), lambda c: c <> '' AND NOT regexp_matches(c, '^(before|after|between|at) ')) AS bad FROM splits)
SELECT id, CASE WHEN verifier = 'instruction' AND len(odd) > 0 THEN 'unsupported_instruction:' || odd[1] WHEN verifier = 'rubric' AND (checks IS NULL OR len(checks) = 0 OR len(list_filter(checks, lambda c: coalesce(c ->> '$.pass_criteria', 'YES') NOT IN ('YES', 'NO'))) > 0) THEN 'invalid_rubric'
 WHEN verifier = 'calendar' AND len(bad) > 0 THEN 'unsupported_calendar_constraint' END AS reason FROM x""")
def q_preflight_reason(t):
    return t("splits").select("id", screening.preflight_reason(KNOWN).alias("reason"))


@query("SELECT id, NOT coalesce(list_contains((verification::JSON -> '$.labels')::VARCHAR[], json_extract_string(verification, '$.answer')), false) AS excluded FROM splits WHERE verifier = 'choice'")
def q_choice_excluded(t):
    return t("splits").filter("verifier = 'choice'").select("id", screening.choice_excluded().alias("excluded"))


@query("SELECT id, NULL::VARCHAR AS reason FROM splits WHERE verifier = 'structure'")
def q_quarantine_reason(t):
    return t("splits").filter("verifier = 'structure'").select("id", screening.quarantine_reason().alias("reason"))


@query("""WITH x AS (SELECT id, ceil(list_sum(list_transform(messages, lambda m: coalesce(length(m.content), 0))) / 4)::INT AS tokens, CASE WHEN task = 'sumtales' THEN 900 WHEN lower(trim(domain)) = 'quality' THEN 1500 ELSE max_new_tokens END AS b,
 CASE WHEN coalesce(starts_with(bucket_semantics, 'nominal published prompt-length profile'), false) THEN 2048 ELSE least(2048, coalesce(context_window, 2048)) END AS lim FROM splits)
SELECT id, tokens, CASE WHEN b > 0 THEN b END AS budget, lim AS "limit", coalesce(tokens + CASE WHEN b > 0 THEN b END <= lim, false) AS admitted FROM x""")
def q_context_admission(t):
    tokens = F.ceil(F.expr("aggregate(messages, 0L, (a, m) -> a + coalesce(length(m.content), 0))") / 4).cast("int")
    budget = screening.response_budget(0, {"sumtales": 900}, {"quality": 1500})
    x = t("splits").select("id", tokens.alias("tokens"), budget.alias("budget"), screening.context_limit(2048).alias("limit"))
    return x.withColumn("admitted", screening.admitted_context(F.col("tokens"), F.col("budget"), F.col("limit")))


@query("""WITH f AS (SELECT id, min(struct_pack(loaded_at := loaded_at, task := task, length_bucket := length_bucket)) AS x FROM splits WHERE id IS NOT NULL GROUP BY id),
k AS (SELECT id, x.task AS task, x.length_bucket AS length_bucket FROM f WHERE coalesce(x.length_bucket, 0) <= 16384 AND coalesce(x.length_bucket, 0) IN (0, 2048, 4096, 16384)),
r AS (SELECT *, row_number() OVER (PARTITION BY task ORDER BY id) AS rn FROM k) SELECT id, task, length_bucket FROM r WHERE rn <= least(50, CASE task WHEN 'sumtales' THEN 20 WHEN 'pickone' THEN 0 ELSE 50 END)""")
def q_run_selection(t):
    return selection.run_selection(_planned(t).select("id", "task", "length_bucket"), "id", 16384, (2048, 4096, 16384), (), 50, {"sumtales": 20, "pickone": 0})


@query("""WITH x AS (SELECT task, CASE WHEN verifier = 'exact' AND lower(trim(domain)) = 'logic' THEN 1 WHEN verifier IN ('math', 'choice', 'instruction', 'retrieval', 'calendar', 'humanevalplus', 'apps', 'exact') THEN 0 WHEN verifier = 'alias' THEN 1 WHEN verifier = 'structure' THEN 2 ELSE 3 END AS u FROM splits)
SELECT task, ['none', 'on_miss', 'to_pass', 'always'][max(u) + 1] AS judge_use FROM x GROUP BY task""")
def q_judge_use(t):
    return grading.judge_use_by_task(t("splits"))


@query("""WITH x AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id)::INT AS turn, min(event_id) OVER (PARTITION BY event_type) AS f FROM events) SELECT event_id, event_type, row_number() OVER (ORDER BY turn, f)::INT AS place FROM x""")
def q_interleave_first_seen(t):
    from pyspark.sql import Window

    x = selection.interleave(t("events").select("event_id", "event_type"), "event_type", ["event_id"])
    return x.select("event_id", "event_type", F.row_number().over(Window.orderBy("turn", "first_seen")).alias("place"))


_AT = " ".join(f"WHEN '{d}' THEN {i}" for i, d in enumerate(screening.DOMAINS, 1))


@query(f"SELECT task, domain, row_number() OVER (ORDER BY CASE domain {_AT} ELSE 11 END, task)::INT AS place FROM (SELECT DISTINCT task, domain FROM source_specs)")
def q_display_order(t):
    return selection.display_order(t("source_specs").select("task", "domain").distinct(), screening.DOMAINS)


# --- versions, audits, calibration, services ------------------------------------------------------------------------


@query(r"""SELECT id AS source_record_id, CASE WHEN lower(trim(domain)) = 'long_context' THEN CASE WHEN verifier = 'retrieval' THEN 4096 ELSE 8192 END WHEN lower(trim(domain)) IN ('math', 'logic', 'quality', 'python') THEN 16384 ELSE 8192 END AS max_new_tokens, 131072 AS context_window,
 CASE WHEN verifier = 'math' THEN regexp_replace(verification, '\}\s*$', ',"answer_policy":"explicit_final_box_v2"}') ELSE verification END AS verification,
 messages[-1].content || CASE WHEN verifier = 'math' THEN chr(10) || 'End with exactly one unambiguous final answer in \boxed{...}. Do not give alternative final answers.' ELSE '' END AS asked,
 CASE WHEN lower(trim(domain)) = 'long_context' THEN ceil(list_sum(list_transform(messages, lambda m: length(m.content))) / 4)::INT END AS reference_prompt_tokens FROM splits
 WHERE NOT (task = 'genbench' AND stratum = 'planning/reward_modeling')""")
def q_revise(t):
    rows, _ = versions.revise(t("splits"), lambda batch: [-(-sum(len(m["content"]) for m in said) // 4) for said in batch])
    return rows.select("source_record_id", "max_new_tokens", "context_window", "verification", F.try_element_at("messages", F.lit(-1))["content"].alias("asked"), "reference_prompt_tokens")


@query(f"""SELECT split, count(*) AS rows, count(DISTINCT id) AS ids, count(*) FILTER (reason IS NOT NULL) AS screened, count(*) FILTER (lower(trim(domain)) = 'long_context') AS long_contexts,
 count(*) = count(DISTINCT id) AND count(*) FILTER (reason IS NOT NULL) = 0 AND (split = 'main_test' OR count(*) FILTER (lower(trim(domain)) = 'long_context') = 0) AS passed FROM (SELECT *, {_SCREEN} AS reason FROM splits) GROUP BY split""")
def q_audit_splits(t):
    return versions.audit_splits(_keyed(t), "keys")[0]


_FIRST = "f AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY loaded_at) AS rn FROM splits WHERE id IS NOT NULL) WHERE rn = 1)"
_TURNS1 = """l AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id, sample ORDER BY stored_at DESC, finished_at DESC, run DESC) AS rn FROM samples WHERE id IS NOT NULL AND sample IS NOT NULL) WHERE rn = 1)"""


def _first(t) -> DataFrame:
    return selection.first_per_key(t("splits").filter("id is not null"), "id", ["loaded_at"])


@query(f"""WITH {_FIRST}, {_TURNS1}, q AS (SELECT l.id || '.' || sample AS request_id, CASE WHEN sample = 3 THEN 'old' ELSE 'p' END AS protocol_id, l.id AS row_id, CASE WHEN sample = 2 THEN 'x' ELSE sha256(coalesce(f.verification, '')) END AS row_hash, l.turns[1].response AS response, f.verifier AS v, coalesce(len(f.turns) > 0, false) AS many
 FROM l JOIN f ON f.id = l.id WHERE len(l.turns) > 0)
SELECT request_id, CASE WHEN protocol_id = 'old' THEN 'protocol changed' WHEN row_hash = 'x' THEN 'unknown or changed row' WHEN v = 'apps' THEN 'quarantined' WHEN many THEN 'several turns' WHEN response.text IS NULL THEN 'no text' WHEN NOT coalesce(response.finish_reason IN ('stop', 'length'), false) THEN 'not a completion' END AS reason, v AS verifier FROM q""")
def q_gold_attach(t):
    f = _first(t)
    rows = f.withColumn("row_hash", json_digest(F.coalesce("verification", F.lit(""))))
    asked = _last(t).filter("size(turns) > 0").join(rows.select("id", "split", F.col("row_hash").alias("h")), "id")
    sent = asked.select(F.concat("id", F.lit("."), F.col("sample").cast("string")).alias("request_id"), F.when(F.col("sample") == 3, "old").otherwise("p").alias("protocol_id"), "split", F.col("id").alias("row_id"), F.when(F.col("sample") == 2, "x").otherwise(F.col("h")).alias("row_hash"), F.col("turns")[0]["response"].alias("response"))
    return versions.attach_gold(sent, rows, "p", f.filter("verifier = 'apps'").select("id")).select("request_id", "reason", "verifier")


@query(f"""WITH {_FIRST}, {_TURNS1}, x AS (SELECT l.id, l.sample, generate_subscripts(l.turns, 1)::INT - 1 AS turn, unnest(l.turns) AS t, greatest(coalesce(len(f.turns), 1), 1) AS expected FROM l JOIN f ON f.id = l.id),
y AS (SELECT id, sample, turn, expected, t.grade.status AS status, t.grade.score AS score, t.grade.passed AS passed, t.response.finish_reason = 'length' AS capped FROM x),
g AS (SELECT id, sample, count(*) AS turns, count(*) FILTER (coalesce(status <> 'valid', true)) > 0 AS bad, count(*) < max(expected) AND NOT coalesce(arg_max(capped, turn) FILTER (capped IS NOT NULL), false) AS short, bool_and(coalesce(passed, false)) AS ok, max(score) AS s, bool_or(passed) AS p, avg(score) AS m FROM y GROUP BY id, sample)
SELECT id, sample, CASE WHEN bad OR short THEN 'error' ELSE 'valid' END AS status, CASE WHEN NOT bad AND NOT short THEN CASE WHEN turns = 1 THEN s ELSE ok::INT::DOUBLE END END AS score, CASE WHEN NOT bad AND NOT short THEN CASE WHEN turns = 1 THEN p ELSE ok END END AS passed,
 CASE WHEN NOT bad AND NOT short AND turns > 1 THEN round(m, 6) END AS turn_fraction, turns FROM g""")
def q_trajectory_grade(t):
    many = _first(t).select("id", F.greatest(F.coalesce(F.size("turns"), F.lit(1)), F.lit(1)).alias("expected"))
    x = _last(t).select("id", "sample", F.posexplode("turns").alias("turn", "t")).join(many, "id")
    return grading.trajectory_grade(x.select("id", "sample", "turn", "expected", F.col("t.grade.status").alias("status"), F.col("t.grade.score").alias("score"), F.col("t.grade.passed").alias("passed"), (F.col("t.response.finish_reason") == "length").alias("capped")), ["id", "sample"], "expected")


@query()
def q_regrade(t):
    x = _last(t).select("id", "sample", F.posexplode("turns").alias("turn", "t")).filter("t.response is not null")
    return versions.regrade(x.select("id", "sample", "turn", F.col("t.response.text").alias("text"), F.col("t.response.finish_reason").alias("finish")), _first(t), "stored")[1]


@query()
def q_failure_by_components(t):
    """Reasons of failures by what the rules found."""
    p = _first(t).select("id", "verifier", "verification", "binary", F.lower(F.trim("domain")).alias("domain"), "task", F.try_element_at("messages", F.lit(-1))["content"].alias("prompt"))
    x = _last(t).filter("size(turns) = 1").select("id", "sample", F.col("turns")[0]["response"].alias("r")).filter("r is not null")
    g = grading.grade(x.select("id", "sample", F.col("r.text").alias("text"), F.col("r.finish_reason").alias("finish")).join(p, "id"), ["id", "sample", "task"])
    d = g.withColumn("valid", F.col("status") == "valid").withColumn("capped", F.col("reason").eqNullSafe("truncated")).withColumn("n_turns", F.lit(1))
    return d.select("task", metrics.failure_reason(F.col("components")).alias("why")).filter("why is not null").groupBy("task", "why").agg(F.count("*").alias("n"))


def _reviewed(t) -> tuple[DataFrame, DataFrame, DataFrame]:
    r = _rec(t).withColumn("case_id", F.concat("id", F.lit("."), F.col("sample").cast("string")))
    role = F.when(selection.held_out(F.col("id")), "heldout").otherwise("development")
    said = r.filter("sample < 3").select("case_id", F.when(F.col("sample") == 2, "pending").otherwise("reviewed").alias("status"), F.lit("r").alias("reviewer_id"), F.lit("why").alias("rationale"), (F.substring("id", 1, 1) < "8").alias("expected_pass"), F.lit(0.5).alias("expected_score"), F.when(F.substring("id", 2, 1) == "0", "odd").alias("reference_issue"))
    return r.select("case_id", "domain", role.alias("role")), r.select("case_id", "status", "score", "passed"), said


@query(f"""WITH {REC}, c AS (SELECT domain, CASE WHEN ('0x' || substr(sha256('"' || id || '"'), 1, 8))::BIGINT % 5 = 0 THEN 'heldout' ELSE 'development' END AS role, status, score, passed, coalesce(sample < 2, false) AS done, substr(id, 1, 1) < '8' AS ep, substr(id, 2, 1) = '0' AS odd FROM rec),
g AS (SELECT domain, role, count(*) FILTER (done) AS reviewed, count(*) FILTER (NOT done) AS pending, count(*) FILTER (done AND NOT coalesce(status = 'valid', false)) AS invalid, count(*) FILTER (done AND NOT ep) AS n, count(*) FILTER (done AND NOT ep AND passed) AS k, count(*) FILTER (done AND ep) AS positives,
 count(*) FILTER (done AND ep AND NOT passed) AS false_rejects, avg(CASE WHEN done AND status = 'valid' THEN abs(score - 0.5) END) AS mae, count(*) FILTER (done AND odd) AS reference_issues FROM c GROUP BY ALL)
SELECT domain, role, reviewed, pending, invalid, n AS negatives, k AS false_accepts, positives, false_rejects, round(mae, 6) AS mae, reference_issues, CASE WHEN n > 0 THEN round(k / n::DOUBLE, 6) END AS false_accept_rate,
 CASE WHEN n > 0 THEN round((k / n::DOUBLE + 3.8416 / (2 * n) + 1.96 * sqrt(k / n::DOUBLE * (1 - k / n::DOUBLE) / n + 3.8416 / (4 * n::DOUBLE * n))) / (1 + 3.8416 / n), 6) END AS false_accept_upper FROM g""")
def q_calibration(t):
    return versions.calibration_report(*_reviewed(t))


@query("SELECT count(*) = 0 AS fine, count(*) AS bad FROM (SELECT id FROM splits WHERE json_extract_string(verification, '$.output_regex') = '(')")
def q_uncompilable(t):
    bad = versions.uncompilable(t("splits"))
    return bad.agg((F.count("*") == 0).alias("fine"), F.count("*").alias("bad"))


@query("""WITH x AS (SELECT user_id, event_id, event_type, ts, left(event_type, 120) AS k FROM events) SELECT event_type AS kind, count(*) AS lines, count(DISTINCT floor(epoch(ts) / 3600)) AS written FROM x GROUP BY 1""")
def q_throttle_totals(t):
    d = requests.throttled(t("events"), "ts", "event_type")
    lines = t("events").groupBy(F.col("event_type").alias("kind")).agg(F.count("*").alias("lines"))
    return d.groupBy(F.col("event_type").alias("kind")).agg(F.count("*").alias("written")).join(lines, "kind").select("kind", "lines", "written")


@query(f"WITH x AS (SELECT doc_id, {_SPLIT.format('text')} AS w FROM documents WHERE text IS NOT NULL) SELECT doc_id, len(w)::INT AS words FROM x")
def q_word_counts(t):
    ws = F.filter(F.split("text", r"(?U)[\s\x1c-\x1f]+"), lambda w: w != "")
    return t("documents").filter("text is not null").select("doc_id", F.size(ws).alias("words"))
