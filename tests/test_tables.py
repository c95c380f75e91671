import datetime as dt
import io
import tarfile

import pytest
from pyspark.sql import functions as F

from gradeloom.functions.ids import normalized
from gradeloom.operators import grading, overlap, screening, selection, splitting
from gradeloom.sources import adapters, files
from gradeloom.streaming import requests


def test_balanced_equals_round_robin(spark):
    rows = [(i, "abc"[i % 7 % 3]) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, s string")
    got = [r.id for r in selection.balanced(df, "s", selection.seeded_rank(42, F.col("id")), "id", 25).orderBy("pick").collect()]
    rank = {r.id: r.rk for r in df.select("id", selection.seeded_rank(42, F.col("id")).alias("rk")).collect()}
    strata = {s: sorted((i for i, x in rows if x == s), key=lambda i: rank[i]) for s in "abc"}
    want = []
    while len(want) < 25:
        for s in sorted(strata):
            if strata[s] and len(want) < 25:
                want.append(strata[s].pop(0))
    assert got == want
    assert selection.balanced(df.limit(0), "s", F.lit("x"), "id", 5).count() == 0


def test_prefix_budget_stops_at_first_overflow(spark):
    df = spark.createDataFrame([("g", 1, 5), ("g", 2, None), ("g", 3, 6), ("g", 4, 1), ("h", 1, 99)], "g string, o int, n int")
    assert sorted((r.g, r.o) for r in selection.prefix_budget(df, "g", ["o"], "n", 10).collect()) == [("g", 1), ("g", 2)]


def _text(i, n=40, change=()):
    return " ".join(f"w{i}x{k}" if k not in change else f"c{k}" for k in range(n))


def test_near_pairs_brute(spark):
    rows = [(1, _text(1)), (2, _text(1, change=(39,))), (3, _text(1)), (4, _text(2)), (5, None), (6, ""), (7, "too short"), (8, _text(1, change=(3, 15, 30)))]
    df = spark.createDataFrame(rows, "id long, text string")
    five = lambda w: {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    sh = {i: five(normalized(t).split()) for i, t in rows if t}
    want = {(a, b) for a in (1, 2, 4, 8) for b in (1, 2, 4, 8) if a < b and len(sh[a] & sh[b]) / len(sh[a] | sh[b]) >= 0.85}
    got = {(r.a, r.b) for r in overlap.near_pairs(df, df, "id", "text").collect()}
    assert got == want and want
    cls = {r.id: (r.class_id, r.links) for r in overlap.near_classes(df, "id", "text").collect()}
    assert cls[3] == (1, 1) and cls[1] == (1, 1) and cls[7] == (7, 0) and 5 not in cls
    assert overlap.near_pairs(df.limit(0), df, "id", "text").count() == 0


def test_overlap_counts(spark):
    df = spark.createDataFrame([("a", ["x", "y"]), ("b", ["y", "y"]), ("b", ["x"]), ("c", ["z"]), ("c", None)], "split string, keys array<string>")
    assert sorted((r.a, r.b, r.shared) for r in overlap.overlap_counts(df, "split", "keys").collect()) == [("a", "b", 2), ("a", "c", 0), ("b", "c", 0)]


def test_build_splits_has_no_leaks(spark):
    rows = []
    for i in range(60):
        task = "t_eval" if i < 12 else "t_val" if i < 24 else "t_train"
        rows.append((f"i{i:02d}", f"f{i:02d}", [f"f{i:02d}"] + (["f03"] if i in (30, 31) else []), _text(5 if i in (4, 40) else 100 + i), "ab"[i % 2], task))
    df = spark.createDataFrame(rows, "id string, family_id string, family_keys array<string>, text string, stratum string, task string")
    specs = spark.createDataFrame([("t_eval", 0, 0, 4), ("t_val", 0, 3, 0), ("t_train", 20, 0, 0)], "task string, train_quota int, val_quota int, test_quota int")
    got = splitting.build_splits(df, specs)[0].collect()
    by = {s: {r.id for r in got if r.split == s} for s in ("main_test", "rl_val", "rl_train")}
    assert [len(by[s]) for s in ("main_test", "rl_val", "rl_train")] == [4, 3, 20]
    assert not by["rl_train"] & {"i30", "i31", "i40"} and all(int(i[1:]) >= 24 for i in by["rl_train"])
    assert splitting.build_splits(df.limit(0), specs)[0].count() == 0
    assert len(splitting.ordered_hash(df.select("id", F.col("text").alias("line")), "id", "line")) == 64


def test_screening(spark):
    schema = "id string, family_id string, task string, domain string, verifier string, source string, verification string, messages array<struct<role string, content string>>, loaded_at int, created_at int"
    ok = [("user", "a question of some length")]
    rows = [("1", "f", "t", "math", "math", "s", "{}", ok, 1, 1), ("2", "f2", "t", "Math", "math", "s", "{}", ok, 1, 1), ("3", "f3", "t", "math", "math", "s", "{}", [("assistant", "x")], 1, 1), ("4", "f4", "t", "math", "math", "s", '{"reference": "I cannot answer that"}', ok, 1, 1),
            ("5", "f5", "t", "math", "math", "", "{}", ok, 1, 1), ("6", "f6", "t", "math", "math", "s", None, None, 1, 1), ("7", "f", "t", "math", "math", "s", "{}", ok, 1, 2)]
    df = spark.createDataFrame(rows, schema)
    got = {r.id: r.r for r in df.select("id", screening.invalid_reason().alias("r")).collect()}
    assert got == {"1": None, "2": "unknown domain", "3": "last role", "4": None, "5": "no source", "6": "no messages", "7": None}
    assert {r.id for r in screening.screened(df).collect()} == {"1"}
    fixed, changes = screening.repair_pattern(df.select("id", "verification"), "reference", "ref")
    assert changes.count() == 1 and fixed.filter("verification like '%ref\"%'").count() == 1


def test_grade_and_judge_stages(spark):
    df = spark.createDataFrame([(1, "math", '{"answer": "2"}', True, "p", "2", "stop", "math"), (2, "quality", '{"rubric": "r"}', False, "p", "long answer", "stop", "quality"), (3, "math", None, None, None, None, None, None)],
                               "k int, verifier string, verification string, binary boolean, prompt string, text string, finish string, domain string")
    g = {r.k: r for r in grading.grade(df, ["k"]).collect()}
    assert g[1].score == 1.0 and g[2].needs_judge and g[2].score is None and g[3].status == "error"
    replies = iter(["nonsense", '{"score": 5, "mandatory_pass": true, "reason": "r"}'])
    j = grading.judge(df.filter("k = 2"), ["k"], lambda rows: [{"text": next(replies)} for _ in rows]).first()
    assert j.score == 1.0 and j.passed is None
    assert grading.judge(df.filter("k = 2"), ["k"], lambda rows: [{"text": "?"} for _ in rows]).first().status == "error"


def test_files(spark, tmp_path):
    df = spark.createDataFrame([('{"a":1}',), ("",), ('{"a":2,"b":"é"}',)], "line string")
    files.write_jsonl(df, f"{tmp_path}/x.jsonl")
    back = files.read_jsonl(spark, f"{tmp_path}/x.jsonl", "a int, b string", ordinals=True)
    assert sorted((r.line, r.a) for r in back.collect()) == [('{"a":1}', 1), ('{"a":2,"b":"é"}', 2)]
    with tarfile.open(tmp_path / "a.tar.gz", "w:gz") as t:
        info = tarfile.TarInfo("d/m.jsonl")
        info.size = 6
        t.addfile(info, io.BytesIO(b"1\n2\n3\n"))
    assert [r.line for r in files.read_tar_members(spark, f"{tmp_path}/a.tar.gz", ["d/m.jsonl"], 2).orderBy("ordinal").collect()] == ["1", "2"]
    with pytest.raises(FileNotFoundError):
        files.read_tar_members(spark, f"{tmp_path}/a.tar.gz", ["nope"])
    (tmp_path / "runs").mkdir()
    (tmp_path / "runs/a.0.json").write_text('{"id": "a", "sample": 0}')
    (tmp_path / "runs/b.0.json").write_text('{"id": "a", "sample": 0}')
    (tmp_path / "runs/c.0.json").write_text("{broken")
    good, bad = files.read_record_files(spark, f"{tmp_path}/runs", "id string, sample int")
    assert good.count() == 1 and {(r.file, r.issue) for r in bad.collect()} == {("b.0.json", "name"), ("c.0.json", "unreadable")}
    assert files.parse_settings("A='x y'\n# c\nexport B=2\n[C]=z") == {"A": "x y", "B": "2", "C": "z"}
    assert files.markdown_table(["a"], [(None,), ("x|y",)]).splitlines()[2] == "|      |"
    files.write_csv(spark.createDataFrame([(1, None)], "a int, b string"), f"{tmp_path}/csv")
    assert files.read_csv(spark, f"{tmp_path}/csv", "a int, b string").first().a == 1


def test_adapters(spark):
    df = spark.createDataFrame([("x #### 4 ", ["A", "B"], ["one", "two"], '["{}", {"k": 1}]')], "s string, l array<string>, t array<string>, k string")
    r = df.select(adapters.answer_after_marks(F.col("s")).alias("a"), adapters.render_options(F.col("l"), F.col("t")).alias("o"), adapters.rule_stratum(F.array(F.lit("x:y"))).alias("rs"), adapters.user_turn(F.col("s")).alias("u")).first()
    assert (r.a, r.o, r.rs, r.u[0].role) == ("4", "\nA. one\nB. two", "x", "user")


def test_request_stream(spark, tmp_path):
    base = dt.datetime(2026, 1, 1)
    rows = [("r1", "a", base), ("r1", "a", base), ("r1", "b", base), ("r2", "c", base)]
    df = spark.createDataFrame(rows, "req string, body string, ts timestamp")
    batch = sorted(r.state for r in requests.request_states(df.withColumn("o", F.monotonically_increasing_id()), "req", "body", ["o"]).collect())
    assert batch == ["accepted", "accepted", "conflict", "repeat"]
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    src = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    q = requests.stream_once(src, "req", "body", "ts").writeStream.format("memory").queryName("states").option("checkpointLocation", f"{tmp_path}/ck").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = sorted((r.request, r.state) for r in spark.table("states").collect())
    assert got.count(("r1", "accepted")) == 1 and ("r2", "accepted") in got and len(got) == 4
    s = requests.interval_stats(src.withColumn("v", F.lit(1.0)), "ts", "req", "v").writeStream.format("memory").queryName("stats").option("checkpointLocation", f"{tmp_path}/ck2").outputMode("complete").trigger(availableNow=True).start()
    s.awaitTermination(120)
    assert {(r.req, r.n) for r in spark.table("stats").collect()} == {("r1", 3), ("r2", 1)}


def test_throttle(spark):
    base = dt.datetime(2026, 1, 1)
    df = spark.createDataFrame([("e", base), ("e", base + dt.timedelta(seconds=5)), ("e", base + dt.timedelta(hours=1))], "k string, ts timestamp")
    assert [(r.held_back) for r in requests.throttled(df, "ts", "k").orderBy("first_at").collect()] == [0, 1]
