from math import comb

from pyspark.sql import functions as F

from gradeloom.operators import metrics as M

REC = "id string, sample int, task string, domain string, run string, valid boolean, status string, score double, passed boolean, error string, capped boolean, n_turns int, completion_tokens long"


def rec(spark, rows):
    full = [(i, s, t, d, "r", st == "valid", st, sc, p, None, cap, 1, tok) for i, s, t, d, st, sc, p, cap, tok in rows]
    return spark.createDataFrame(full, REC)


def test_pass_at_k(spark):
    cases = [(n, c, k) for n in range(1, 9) for c in range(n + 1) for k in (1, 2, 4)]
    for k in (1, 2, 4):
        df = spark.createDataFrame([(n, c) for n, c, kk in cases if kk == k], "n int, c int")
        for r in df.withColumn("v", M.pass_at_k(F.col("n"), F.col("c"), k)).collect():
            want = None if k > r.n else 1.0 if r.n - r.c < k else 1 - comb(r.n - r.c, k) / comb(r.n, k)
            assert r.v is None if want is None else abs(r.v - want) < 1e-12
    bad = spark.createDataFrame([(2, 3), (2, -1)], "n int, c int").withColumn("v", M.pass_at_k(F.col("n"), F.col("c"), 1)).collect()
    assert [r.v for r in bad] == [None, None]


def test_rollup_incomplete_and_capped(spark):
    r = rec(spark, [
        ("a", 0, "t", "math", "valid", 1.0, True, False, 5), ("a", 1, "t", "math", "valid", 1.0, True, True, 5),  # capped counts 0
        ("b", 0, "t", "math", "valid", 1.0, True, False, 5), ("b", 1, "t", "math", "error", None, None, False, None),  # incomplete
        ("c", 0, "u", "logic", "valid", 0.5, None, False, 5), ("c", 1, "u", "logic", "valid", 1.0, None, False, 5),  # no verdicts
    ])
    p = {x.id: x for x in M.prompt_rollup(r, 2).collect()}
    assert (p["a"].score, p["a"].passes) == (0.5, 1) and p["b"].score is None and (p["c"].score, p["c"].passes) == (0.75, None)
    t = {x.task: x for x in M.task_rollup(M.prompt_rollup(r, 2), 2).collect()}
    assert (t["t"].complete, t["t"].incomplete, t["t"].pass_at_1, t["t"].pass_at_2) == (1, 1, 0.5, 1.0) and t["t"].stderr is None and t["u"].pass_at_1 is None


def test_distribution_of_dirty_numbers(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 128.0, 256.0, 512.0, None, float("nan"), -1.0, float("inf"))], "x double")
    d = M.distribution(df, "x").first()
    assert (d.n, d.missing, d.total, d.p50) == (4, 4, 896.0, 192.0) and abs(d.p95 - 473.6) < 1e-9
    empty = M.distribution(df.limit(0), "x").first()
    assert (empty.n, empty.missing, empty.p50) == (0, 0, None)
    h = M.token_histogram(df.selectExpr("cast(if(isnan(x) or x > 1e9, null, x) as long) as x"), "x").orderBy("bucket").collect()
    assert [r.n for r in h][:4] == [1, 1, 1, 1] and sum(r.n for r in h) == 4 and len(h) == 12


def test_coverage_and_groups(spark):
    ids = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    r = rec(spark, [("a", 0, "t", "d", "valid", 1.0, True, False, 1), ("a", 1, "t", "d", "valid", 0.0, False, False, 1), ("b", 0, "t", "d", "error", None, None, False, 1), ("b", 1, "t", "d", None, None, None, False, 1)])
    got = sorted((x.id, x.sample, x.state) for x in M.coverage_grid(ids, r, 2).collect())
    assert got == [("a", 0, "valid"), ("a", 1, "valid"), ("b", 0, "error"), ("b", 1, "pending"), ("c", 0, "missing"), ("c", 1, "missing")]
    assert M.pending_work(ids, r, 2).count() == 4
    assert {x.id: x.accepted for x in M.group_validation(r, 2).collect()} == {"a": True, "b": False}
    assert M.coverage_grid(ids.limit(0), r, 2).count() == 0


def test_guards(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 4.0)], "x double, y double")
    assert df.agg(M.guarded_corr("x", "y").alias("r")).first().r is None
    assert df.limit(2).agg(M.guarded_corr("y", "y").alias("r")).first().r is None
    assert df.agg(M.wilson_upper(F.lit(0), F.lit(0)).alias("w")).first().w is None
    many = spark.createDataFrame([(k, float(x)) for k in "ab" for x in [5, 1, 1, 1, 9, 7]] + [("c", None)], "k string, y double")
    got = {r.k: (r.p50, r.p95, r.p0) for r in M.nearest_lower(many, ["k"], "y", [0.5, 0.95, 0.0], ["p50", "p95", "p0"]).collect()}
    assert got == {"a": (1.0, 7.0, 1.0), "b": (1.0, 7.0, 1.0)}
    assert M.nearest_lower(many.limit(0), ["k"], "y", [0.5], ["p50"]).count() == 0


def test_failure_reasons_from_components(spark):
    rows = [("a", '{"failure": "empty_response"}'), ("b", '{"execution_status": "failed", "defines_entry_point": false}'), ("c", '{"execution_status": "timeout"}'), ("d", '{"syntax": false}'), ("e", '{"schema": false}'), ("f", '{"requested_format": false}'), ("g", '{"acceptability": false, "mandatory_pass": false}'), ("h", None)]
    df = spark.createDataFrame([(i, c, True, False, 0.0, False, 1) for i, c in rows], "id string, c string, valid boolean, passed boolean, score double, capped boolean, n_turns int")
    got = {r.id: r.w for r in df.select("id", M.failure_reason(F.col("c")).alias("w")).collect()}
    assert got == {"a": "empty response", "b": "code: requested function not defined", "c": "code: timeout", "d": "unparseable structure", "e": "schema mismatch", "f": "answer in other format", "g": "mandatory check failed", "h": "wrong answer"}


def test_repetition(spark):
    df = spark.createDataFrame([(1, "a b c d a b c d"), (2, "a b"), (3, None), (4, "x " * 5000)], "id int, t string")
    got = {r.id: r.v for r in M.repeated_grams(df, "t", "v").collect()}
    assert got[1] == 1 - 4 / 5 and got[2] == got[3] == 0.0 and got[4] > 0.99


def watched(spark, rows):
    """Records and samples of (id, domain, score, text, tokens)."""
    r = rec(spark, [(i, 0, "t", d, "valid", s, None, False, k) for i, d, s, _, k in rows])
    turn = "turns array<struct<response struct<text string, usage struct<completion_tokens int>>>>"
    return r, spark.createDataFrame([(i, 0, [{"response": {"text": x, "usage": {"completion_tokens": k}}}]) for i, _, _, x, k in rows], f"id string, sample int, {turn}")


def once_repeated(grams):
    """A text of so many runs of 4 words, one of which stands twice."""
    return " ".join([f"w{i}" for i in range(grams - 1)] + ["w0", "w1", "w2", "w3"])


def test_no_variance_in_several_partitions(spark):
    for n, parts, x in ((98, 2, 1.0), (107, 3, 0.7), (400, 3, 0.3)):
        df = spark.range(0, n, 1, parts).select(F.lit(x).alias("x"), F.col("id").cast("double").alias("y"))
        assert df.agg(M.guarded_corr("x", "y").alias("r"), M.guarded_corr("y", "x").alias("s")).first() == (None, None)


def test_reliability_of_shares_as_reported(spark):
    grams = (1600, 1900, 2600, 5000)  # their shares move by a thousandth when they are cut to 6 places
    rows = [(str(n), "d", s, once_repeated(n), 1) for n, s in zip(grams, (0.0, 1.0, 0.25, 0.5))]
    x, y = [r[2] for r in rows], [round(1 / n, 6) for n in grams]
    mx, my = sum(x) / 4, sum(y) / 4
    want = sum((a - mx) * (b - my) for a, b in zip(x, y)) / (sum((a - mx) ** 2 for a in x) * sum((b - my) ** 2 for b in y)) ** 0.5
    got = M.reliability(*watched(spark, rows)).first()
    assert abs(got.score_repetition - want) < 1e-9 and got.score_length is None and (got.samples, got.errors) == (4, 0)


def test_audit_queue_of_shares_as_reported(spark):
    r, s = watched(spark, [("a", "d", 1.0, once_repeated(1449), 5), ("b", "d", 1.0, once_repeated(1450), 9)])  # both 0.00069
    assert [(x.id, x.repetition) for x in M.audit_queue(r, s).orderBy("place").collect()] == [("b", 0.00069), ("a", 0.00069)]
