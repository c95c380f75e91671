"""The protocol's numbers on small cases."""

from gradeloom.operators import protocol as P
from gradeloom.operators.screening import DOMAINS

PLAN = "id string, task string, domain string, stratum string, binary boolean, length_bucket int"
REC = "id string, sample int, task string, domain string, run string, valid boolean, status string, score double, passed boolean, error string, capped boolean, n_turns int, completion_tokens long"


def records(spark, rows):
    return spark.createDataFrame([(i, s, t, d, "r", st == "valid", st, sc, p, None, cap, 1, 5) for i, s, t, d, st, sc, p, cap in rows], REC)


def test_domains_of_different_size_weigh_the_same(spark):
    plan = spark.createDataFrame([(f"{d}{i}", f"task_{d}", d, "default", True, None) for k, d in enumerate(DOMAINS) for i in range(k + 1)], PLAN)
    rec = records(spark, [(f"{d}{i}", 0, f"task_{d}", d, "valid", float(k == 0), k == 0, False) for k, d in enumerate(DOMAINS) for i in range(k + 1)])
    domains = P.domain_scores(P.task_scores(P.prompt_scores(plan, rec, 1), 1))
    a = P.aggregate_scores(domains).first()
    assert (a.score, a.domains, a.complete, a.missing, a.partial) == (10.0, 10, True, "", "")
    fewer = rec.filter(f"id <> '{DOMAINS[-1]}0'")
    a = P.aggregate_scores(P.domain_scores(P.task_scores(P.prompt_scores(plan, fewer, 1), 1))).first()
    assert (a.score, a.complete, a.partial) == (10.0, False, DOMAINS[-1])
    a = P.aggregate_scores(P.domain_scores(P.task_scores(P.prompt_scores(plan, rec.filter("domain <> 'logic'"), 1), 1))).first()
    assert a.missing == "logic" and a.domains == 9


def test_capped_errors_and_pass_at_k(spark):
    plan = spark.createDataFrame([("a", "t", "math", "x/y", True, None), ("b", "t", "math", "x/y", True, None), ("c", "u", "math", "default", False, None)], PLAN)
    rec = records(spark, [("a", 0, "t", "math", "valid", 1.0, True, False), ("a", 1, "t", "math", "valid", 1.0, True, True), ("b", 0, "t", "math", "valid", 1.0, True, False), ("b", 1, "t", "math", "error", None, None, False), ("c", 0, "u", "math", "valid", 0.5, None, False), ("c", 1, "u", "math", "valid", 0.25, None, False), ("zz", 0, "t", "math", "valid", 1.0, True, False)])
    p = P.prompt_scores(plan, rec, 2)
    by = {r.id: r for r in p.collect()}
    assert (by["a"].score, by["a"].passes, by["a"].cut) == (0.5, 1, 1) and by["b"].score is None and by["c"].passes is None and set(by) == {"a", "b", "c"}
    t = {r.task: r for r in P.task_scores(p, 2, (2,)).collect()}
    assert (t["t"].planned, t["t"].prompts, t["t"].pass_at_1, t["t"].pass_at_2, t["t"].truncated) == (2, 1, 0.5, 1.0, 1) and t["u"].pass_at_1 is None and t["u"].stderr is None
    d = P.domain_scores(P.task_scores(p, 2), weights={"t": 0.5}).first()
    assert abs(d.score - (0.5 * 0.5 + 0.375) / 1.5) < 1e-9 and d.pass_at_1 is None and not d.complete
    s = P.run_state(p).first()
    assert (s.errors, s.incomplete, s.truncated, s.truncation_free, s.comparable) == (1, 1, 1, False, False)
    assert P.prompt_scores(plan.limit(0), rec, 2).count() == 0


def test_quality_groups_override_only_if_none_is_empty(spark):
    strata = [("biggen", "refinement/essay", 1, 1.0), ("biggen", "tone/chatting", 1, 0.5), ("biggen", "planning/travel", 1, 0.0), ("biggen", "theory/role_playing", 1, 1.0), ("biggen", "grounding/replanning", 1, 1.0)]
    df = spark.createDataFrame(strata, "task string, stratum string, prompts long, score double")
    g = {r.group: (r.strata, r.score, r.weight) for r in P.quality_groups(df).collect()}
    assert g == {"writing": (1, 1.0, 0.3), "chat": (1, 0.5, 0.3), "planning": (2, 0.5, 0.3), "roleplay": (1, 1.0, 0.1)}
    tasks = spark.createDataFrame([("quality", "biggen", 5, 5, 0.7, 0.5), ("math", "gsm8k", 1, 1, 0.2, 0.2), ("quality", "empty", 3, 0, None, None)], "domain string, task string, planned long, prompts long, score double, pass_at_1 double")
    d = {r.domain: r for r in P.domain_scores(tasks, P.quality_groups(df)).collect()}
    assert abs(d["quality"].score - (0.3 + 0.15 + 0.15 + 0.1)) < 1e-9 and d["math"].score == 0.2 and not d["quality"].complete
    some = P.domain_scores(tasks, P.quality_groups(df.filter("stratum <> 'tone/chatting'"))).filter("domain = 'quality'").first()
    assert some.score == 0.7


def test_long_contexts(spark):
    df = spark.createDataFrame([("long_4096_rag",), ("long_4096_icl",), ("long_8192_niah_single_1",), ("long_x",)], "task string")
    assert [r.w for r in df.select(P.long_weight(df.task).alias("w")).collect()] == [0.3, 0.3, 0.04, 0.04]
    prompts = spark.createDataFrame([("a", "long_4096_rag", "long_context", "rag", True, 4096, 1.0), ("b", "long_4096_vt", "long_context", "vt", True, 4096, 0.0), ("c", "long_8192_vt", "long_context", "vt", True, 8192, None)], PLAN + ", score double").selectExpr("*", "0 as cut", "cast(null as long) as passes")
    turns = spark.createDataFrame([("a", 3900), ("a", 4000), ("b", None)], "id string, prompt_tokens int")
    got = {r.length_bucket: r for r in P.length_scores(prompts, P.task_scores(prompts, 1), turns).collect()}
    assert abs(got[4096].score - 0.3 / 0.34) < 1e-9 and (got[4096].least_tokens, got[4096].most_tokens) == (3900, 4000) and got[8192].score is None


def test_judge_stats_and_lists(spark):
    a = spark.createDataFrame([("valid", 0, "stop", True, 5, 1.0), ("error", 1, "length", None, None, float("nan")), (None, 2, None, False, 7, None)], "status string, attempt int, finish string, fenced boolean, completion_tokens int, latency double")
    r = P.judge_stats(a).first()
    assert (r.attempts, r.failed, r.retries, r.fenced, r.cut_off, r.completion_tokens, r.seconds) == (3, 2, 2, 1, 1, 12.0, 1.0)
    v = {(r.error, r.n, r.place) for r in P.counted_values(spark.createDataFrame([("t", "x"), ("t", "y"), ("t", "y"), ("t", None)], "task string, error string"), ["task"], "error", "unspecified").collect()}
    assert v == {("y", 2, 1), ("unspecified", 1, 2), ("x", 1, 3)}
