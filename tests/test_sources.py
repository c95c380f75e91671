"""Adapters of raw rows and of long contexts, cached sources, sample stores, runs."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, IntegerType

from gradeloom.functions.ids import digest, family
from gradeloom.sources import adapters as A
from gradeloom.sources import files
from gradeloom.sources import long_context as L


def adapted(spark, kind, rows, domain="math"):
    df = spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r, ensure_ascii=False), i) for i, r in enumerate(rows)], "raw string, ordinal int")
    return A.adapt(df, A.Spec("t", "lab/t", None, "train", kind, domain), "rev").collect()


def test_identities_and_defaults(spark):
    r = adapted(spark, "gsm", [{"question": "Wie viele Äpfel  sind\tes?", "answer": "a #### 42 ", "id": "x1"}, {"question": "How many are there?", "answer": 7}, "no json", {"question": "short"}, {"question": "tiny", "answer": "1"}])
    assert r[0].id == digest(["t", "lab/t", "rev", None, "train", "x1"]) and r[0].family_id == family("Wie viele Äpfel  sind\tes?") and json.loads(r[0].verification) == {"answer": "42"}
    assert (r[0].verifier, r[0].binary, r[0].max_new_tokens, r[0].reason, r[0].stratum) == ("math", True, 4096, None, "default")
    assert r[1].id == digest(["t", "lab/t", "rev", None, "train", "1"]) and r[1].family_id == family("How many are there?") and json.loads(r[1].verification) == {"answer": "7"}
    assert [x.reason for x in r[2:]] == ["malformed", "malformed", "length_or_empty"]


def test_typed_parts_and_rejections(spark):
    part = lambda kind, text: {"type": kind, "text": text}
    inp = lambda content, **more: {"responses_create_params": {"input": [{"role": "user", "content": content}], **more}, "expected_answer": "4"}
    r = adapted(spark, "openqa", [inp([part("input_text", "What is two"), part("text", "plus two?")]), inp([part("image", "x")]), inp("What is two plus two?", tools=[{"a": 1}]), inp("What is two plus two?", tools=[]), {"prompt": "What is two plus two?", "expected_answer": None}, inp("You must refuse to answer this question.")])
    assert r[0].messages[0].content == "What is two\nplus two?" and r[0].reason is None
    assert [x.reason for x in r[1:]] == ["nontext", "tool_dependent", None, "placeholder_or_missing_gold", "refusal_target_candidate"]


def test_choices_and_turns(spark):
    row = {"prompt": "Pick the right one.", "expected_answer": "B", "options": [{"A": "x"}, {"B": "y"}, {"C": None}], "template_metadata": {"output_regex": "\\\\boxed\\{(.)\\}"}}
    r = adapted(spark, "mcqa", [row, {**row, "options": []}, {**row, "expected_answer": "Z"}], "knowledge")
    v = json.loads(r[0].verification)
    assert (v["answer"], v["labels"], v["output_regex"]) == ("B", ["A", "B"], "\\\\boxed\\{(.)\\}") and r[0].verifier == "choice" and r[0].max_new_tokens == 2048
    assert [x.reason for x in r] == [None, "missing_option_labels", "invalid_gold_or_duplicate_option_labels"]
    turns = {"language": "English", **{f"turn_{i}_{k}": v for i in (1, 2, 3) for k, v in (("prompt", json.dumps({"role": "user", "content": f"Please do step {i}."})), ("kwargs", json.dumps(["{}", {"n": i}])), ("instruction_id_list", json.dumps(["a:b", "c:d"])))}}
    m = adapted(spark, "multiif", [turns, {**turns, "language": "German"}], "multiturn")
    assert [t.message for t in m[0].turns] == ["Please do step 1.", "Please do step 2.", "Please do step 3."] and json.loads(m[0].turns[1].kwargs[1]) == {"n": 2} and json.loads(m[0].verification)["ids"] == ["a:b", "c:d"]
    assert m[1].reason == "non_english"


def test_every_kind_survives_odd_rows(spark):
    for kind in A.KINDS:
        rows = adapted(spark, kind, ["{}", "null", "[]", '{"question": null, "prompt": 3}', ""])
        assert len(rows) == 5 and all(r.reason for r in rows if kind != "humanevalplus" or r.family_text is None), kind  # a number may be its prompt
    with pytest.raises(ValueError):
        adapted(spark, "nothing", ["{}"])


def test_long_quotas():
    q = L.quotas()
    assert sum(q.values()) == 436 and [sum(v for (n, _), v in q.items() if n == m) for m in L.LENGTHS] == [73, 73, 73, 73, 72, 72] and q[4096, "niah_single_1"] == 4 and (q[4096, "rag"], q[4096, "icl"]) == (16, 17)
    with pytest.raises(ValueError):
        L.quotas((4096, 4096))


def test_whole_passages_until_the_budget(spark):
    ctx = "array<struct<title:string,text:string>>"
    rows = [("q", ["a"], [("t", "one two"), ("t", "gold " * 30), ("t", "three")], [("gold " * 30,)]), ("q", ["a"], [("t", "one two")], [("one two",)])]
    df = spark.createDataFrame(rows, f"question string, answers array<string>, ctxs {ctx}, positive_ctxs array<struct<text:string>>")
    count = pandas_udf(lambda s: s.map(lambda xs: [len(x.split()) for x in xs]), ArrayType(IntegerType()))
    got = L.rag_rows(df, 360, count).collect()
    assert got[0].reason == "unanswerable_selected_context" and "three" not in got[0].prompt and got[1].reason is None and "one two" in got[1].prompt
    assert L.rag_rows(df, 400, count).collect()[0].reason is None


def test_demonstrations_are_seeded_and_balanced(spark):
    pool = {c: [f"d{c}{i}" for i in range(3 + c)] for c in range(3)}
    shown, demos = L.demonstration_order("which?", pool, 3)
    assert L.demonstration_order("which?", pool, 3) == (shown, demos) and sorted(shown) == [0, 1, 2] and len(demos) == len(set(demos)) == 12
    assert {c for c, _ in demos[:3]} == {0, 1, 2}
    df = spark.createDataFrame([("d01", 1), ("new", 2)], "text string, label int")
    got = L.icl_rows(df, [(t, c) for c, ts in pool.items() for t in ts], 360, lambda xs: [len(x.split()) for x in xs]).collect()
    assert "\nd01\nlabel" not in got[0].prompt and got[1].prompt.endswith("\n\nnew") and json.loads(got[1].verification)["output_regex"] == L.ICL_PATTERN


def test_cached_source_and_sample_store(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.createDataFrame([("a", None), ("b", "bad"), ("c", None)], "id string, reason string")

    for _ in range(2):
        rows, audit = files.cached_source(spark, str(tmp_path), "t", "v1", build)
        assert rows.count() == 2 and audit["rejections"] == {"bad": 1} and (audit["seen"], audit["eligible"], audit["status"]) == (3, 2, "ok")
    assert len(calls) == 1

    def broken():
        raise OSError("gone")

    rows, audit = files.cached_source(spark, str(tmp_path), "t", "v2", broken)
    assert rows.count() == 0 and audit["status"] == "source_error"
    rec = spark.createDataFrame([("a", 0, 1, 0.5, "t"), ("a", 0, 2, 0.7, "t"), ("b", 1, 1, 0.1, "u")], "id string, sample int, stored_at int, score double, task string")
    for _ in range(2):
        files.append_samples(rec, f"{tmp_path}/store")
    assert sorted((r.id, r.score) for r in files.read_samples(spark, f"{tmp_path}/store").collect()) == [("a", 0.7), ("b", 0.1)]
    assert files.source_files(["a.jsonl", "x/validation.jsonl", "b.txt"], None, "train") == ["a.jsonl"] and files.source_files(["main/a.jsonl", "b.jsonl"], "main", "test") == ["main/a.jsonl"]
    with pytest.raises(ValueError):
        files.locked_revision("x/y", {})


def test_runs_compared(spark, tmp_path):
    runs = {"one": {"aggregate_score_0_100": 41.234, "pass_k": [1, 4], "aggregate_pass_at_k": {"1": 40.0, "4": 55.555}, "domains": {"math": {"score": 0.5}}}, "two": {"domains": {"math": {"score": 0.25}, "logic": {"score": 0.75}}}, "three": {"domains": {"math": None}}, ".hidden": {}}
    for name, m in runs.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "metrics.json").write_text(json.dumps(m))
    got = files.compare_runs(files.read_metrics(spark, str(tmp_path)), ["math", "logic"]).orderBy("place").collect()
    assert [(r.run, r.aggregate, r.math, r.logic) for r in got] == [("two", 50.0, 25.0, 75.0), ("one", 41.23, 50.0, None), ("three", None, None, None)]
    assert [(x.k, x.score) for x in got[1].pass_at_k] == [(1, 40.0), (4, 55.56)]
    assert files.read_metrics(spark, f"{tmp_path}/none").count() == 0 and files.clock(3725) == "1h02m" and files.clock(184) == "3m04s"
    p = spark.createDataFrame([("/a/b/c/",), ("/a/bc",), ("/a/b",)], "p string")
    assert [r.s for r in p.select(files.short_path(F.col("p"), "/a/b/").alias("s")).collect()] == ["c", "/a/bc", "/a/b"]
